"""Language of texts by prediction by partial matching over bytes."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anticipa.llm.tokens import worker_cache

ORDER = 3
SAMPLE_ROWS, MOST_CONTEXTS, LEAST_COUNT = 1500, 12_000, 4
UNKNOWN = "und"
_BYTES_AT_ONCE = 1 << 17


@dataclass
class Model:
    """Code lengths under frozen statistics, a tree for each language.

    `keys[o]` are the contexts of o bytes that any tree keeps (bytes read as one number, sorted), `rows[o]` their
    rows in `own`: own[row, language] is the row in `bits` of the longest suffix that the language's tree keeps, and
    bits[row, byte] the exact code length of a byte after it, escapes to shorter contexts included.
    """

    languages: list[str]
    keys: list[np.ndarray]
    rows: list[np.ndarray]
    own: np.ndarray
    bits: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Code length in bits of every text under every language."""
        out = np.zeros((len(texts), len(self.languages)))
        for i, text in enumerate(texts):
            data = b"\0" * ORDER + text.encode("utf-8", "surrogatepass")  # texts begin after zero bytes, in training too
            for a in range(0, len(data) - ORDER, _BYTES_AT_ONCE):
                piece = np.frombuffer(data[a : a + _BYTES_AT_ONCE + ORDER], np.uint8)
                context = (piece[:-3].astype(np.int32) << 16) | (piece[1:-2].astype(np.int32) << 8) | piece[2:-1]
                row = self.place[context]
                for k, own in enumerate(self.own.T):
                    out[i, k] += self.flat[own[row] + piece[3:]].sum(dtype=np.float64)
        return out

    def prepare(self) -> "Model":
        """Every context of `ORDER` bytes gets the row of its longest kept suffix; done once in a worker."""
        if hasattr(self, "place"):
            return self
        place = np.zeros((256, 256, 256), np.uint16 if len(self.own) <= 1 << 16 else np.uint32)
        for o in range(1, ORDER + 1):
            for key, row in zip(self.keys[o], self.rows[o]):
                a, b, c = int(key) >> 16 & 255, int(key) >> 8 & 255, int(key) & 255
                place[(slice(None), slice(None), c) if o == 1 else (slice(None), b, c) if o == 2 else (a, b, c)] = row
        self.place, self.flat = place.reshape(-1), self.bits.reshape(-1)
        self.own = np.asfortranarray(self.own.astype(np.int64) * 256)  # where a row of `flat` begins
        return self


def sampled(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """`rows` distinct texts of every language, or all if it has fewer: those whose hashes are the least, whatever the layout.

    Copies of a text count once, so the number is a bound and every labelled language keeps some texts.
    """
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("_hash", F.xxhash64("text"))
    share = F.pmod("_hash", F.lit(1 << 40)) / F.lit(float(1 << 40))
    distinct = known.select("lang", "_hash").distinct()
    counts = distinct.groupBy("lang").count()
    # About twice as many as wanted, or all if there are fewer: bounded by the languages, as no text counts twice.
    near = distinct.join(F.broadcast(counts), "lang").where(share * F.col("count") < 2 * rows).select("lang", share.alias("share"))
    limits = [(lang, float(np.sort(found)[:rows][-1])) for lang, found in near.toPandas().groupby("lang")["share"]]
    limit = labelled.sparkSession.createDataFrame(limits, "lang string, most double")
    return known.join(F.broadcast(limit), "lang").where(share <= F.col("most")).select("lang", "text").distinct()


def train(
    labelled: DataFrame, rows: int = SAMPLE_ROWS, contexts: int = MOST_CONTEXTS, once_a_text: bool = False
) -> Model | None:
    """A model of the languages of `labelled` (text, lang); None without labelled rows.

    It learns from a bounded sample, at most `rows` distinct texts a language. Contexts are kept by how often they
    occur in their language, `contexts` of them a language at most and none under `LEAST_COUNT` times, so the model's
    size is bounded too, and no language's tree depends on the others. With `once_a_text` a string counts once in each text,
    so that a long text that repeats itself does not make all others of its language look like noise.
    """

    def strings(data: bytes) -> np.ndarray:
        piece = np.frombuffer(data, np.uint8).astype(np.int64)
        return piece[:-3] << 24 | piece[1:-2] << 16 | piece[2:-1] << 8 | piece[3:]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                data = [b"\0" * ORDER + t.encode("utf-8", "surrogatepass") for t in texts]
                found = np.concatenate([np.unique(strings(d)) for d in data]) if once_a_text else strings(b"".join(data))
                grams, n = np.unique(found, return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})

    counted = sampled(labelled, rows).mapInPandas(count, "lang string, gram long, n long")
    # Four-byte strings of the sample: as many as its bounded number of rows has.
    grams = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    return build(grams, contexts) if len(grams) else None


def build(grams: pd.DataFrame, contexts: int = MOST_CONTEXTS) -> Model:
    """Trees and code lengths from counts (lang, gram, n) of four-byte strings."""
    grams = grams[(grams["gram"] & 255) != 0]  # what leads into the next text
    languages = sorted(grams["lang"].unique())
    trees = []
    for lang in languages:
        counted = grams[grams["lang"] == lang]
        trees.append(_tree(counted["gram"].to_numpy(np.int64), counted["n"].to_numpy(np.float64), contexts))
    keys = [np.unique(np.concatenate([kept[o] for kept, _ in trees])) for o in range(ORDER + 1)]
    ends = np.cumsum([len(k) for k in keys])
    rows = [np.arange(end - len(k), end) for k, end in zip(keys, ends)]
    first = np.cumsum([0, *(len(bits) for _, bits in trees)])
    own = [np.concatenate([_longest(kept, k, o) for o, k in enumerate(keys)]) + f for (kept, _), f in zip(trees, first)]
    return Model(languages, keys, rows, np.stack(own, axis=1), np.concatenate([bits for _, bits in trees]))


def _tree(gram: np.ndarray, n: np.ndarray, contexts: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The kept contexts of every order, and the code lengths after them order by order, of one language."""
    # Order -1 is uniform; each order escapes to the one below with the share of distinct bytes (method C).
    kept: list[np.ndarray] = []
    p = np.full((1, 256), 1 / 256)
    for o in range(ORDER + 1):
        found, at = np.unique(gram >> 8 & ((1 << 8 * o) - 1), return_inverse=True)
        total = np.bincount(at, n)
        if o:
            keep = total >= LEAST_COUNT
            limit = contexts * (1, 2, 4)[o - 1] // 7
            if keep.sum() > limit:
                keep &= total >= np.sort(total[keep])[-limit]
                keep[np.flatnonzero(keep)[limit:]] = False
        else:
            keep = np.ones(len(found), bool)
        new, own = np.cumsum(keep) - 1, keep[at]
        counts = np.zeros((int(keep.sum()), 256))
        np.add.at(counts, (new[at[own]], gram[own] & 255), n[own])
        sums, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
        base = p[_longest(kept, found[keep], o - 1)] if o else p
        here = (counts + kinds * base) / (sums + kinds)
        p = np.concatenate([p, here]) if o else here
        kept.append(found[keep])
    return kept, -np.log2(p).astype(np.float32)


def _longest(kept: list[np.ndarray], contexts: np.ndarray, order: int) -> np.ndarray:
    """The number, order by order, of the longest suffix in `kept` of at most `order` bytes of every context."""
    out, first = np.zeros(len(contexts), np.int64), 1  # order 0 is one context, always kept
    for o in range(1, order + 1):
        suffix = contexts & ((1 << 8 * o) - 1)
        at = np.searchsorted(kept[o], suffix)
        there = at < len(kept[o])
        there[there] = kept[o][at[there]] == suffix[there]
        out[there] = first + at[there]
        first += len(kept[o])
    return out


def predicted(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    known = [t if t is not None and any(map(str.isalpha, t)) else None for t in texts]
    some = [t for t in known if t is not None]
    lengths = model.scores(some) if some else np.empty((0, len(model.languages)))
    best = lengths.argmin(axis=1) if some else []
    # The posterior of the best language, under equal priors, from the code lengths.
    shares = 1 / np.exp2(-(lengths - lengths.min(axis=1, keepdims=True))).sum(axis=1) if some else []
    rows = iter(zip(best, shares))
    out = [(UNKNOWN, 0.0) if t is None else (lambda r: (model.languages[r[0]], float(r[1])))(next(rows)) for t in known]
    return [o[0] for o in out], [o[1] for o in out]


def identify(docs: DataFrame, model: Model | None, text: str = "text", name: str = "language") -> DataFrame:
    """`docs` with the column `name` (lang_pred, score): the language in which the whole text has the shortest code.

    score is that language's posterior under equal priors. Null texts, texts without a letter, and all texts if there
    is no model, are `und` with score 0. Ties go to the language first in order. Repeated rows are judged alike.
    """
    if model is None:
        nothing = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        return docs.withColumn(name, nothing)
    frozen = docs.sparkSession.sparkContext.broadcast(model)  # bounded by its number of contexts

    @F.pandas_udf("lang_pred string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker_cache.cache_clear()  # of a stage before this one in the same worker: the model needs the room
        ready = frozen.value.prepare()
        for texts in batches:
            langs, scores = predicted(ready, texts.tolist())
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return docs.withColumn(name, of(F.col(text)))


def recognised(docs: DataFrame, model: Model | None, text: str = "text", name: str = "recognised") -> DataFrame:
    """`docs` with the column `name`: whether some language of the model codes the whole text in under 8 bits a byte.

    A text that is no shorter in any language than without a model is in none of them: another script, or noise. Null texts
    and texts without a letter are not recognised, nor is any text if there is no model. Repeated rows are judged alike.
    """
    if model is None:
        return docs.withColumn(name, F.lit(False))
    frozen = docs.sparkSession.sparkContext.broadcast(model)  # bounded by its number of contexts

    @F.pandas_udf("boolean")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_cache.cache_clear()  # of a stage before this one in the same worker: the model needs the room
        ready = frozen.value.prepare()
        for texts in batches:
            able = [t is not None and any(map(str.isalpha, t)) for t in texts]
            some = [t for t, a in zip(texts, able) if a]
            sizes = np.array([8 * len(t.encode("utf-8", "surrogatepass")) for t in some])
            short = iter(ready.scores(some).min(axis=1) < sizes if some else [])
            yield pd.Series([bool(next(short)) if a else False for a in able])

    return docs.withColumn(name, of(F.col(text)))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
