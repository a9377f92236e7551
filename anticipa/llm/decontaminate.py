"""Benchmark passages in training documents, found through a positional inverted index."""

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anticipa.session import written

WINDOW_WORDS = 10
SEGMENT_WORDS = 2_000_000
ANCHORS = 3
WINDOW_BLOCK = 100_000
BROADCAST_ROWS = 300_000
MATCHES = "segment long, window_id long, size int, starts array<int>"
# Byte by byte: A-Z to lower case, the other ASCII characters that are no letter or digit to spaces.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def build_index(docs: DataFrame) -> DataFrame:
    """The positional index of `docs` (doc_id, text), written to the shared folder.

    Documents are laid end to end in segments of about `SEGMENT_WORDS` words, a longer document alone. Two kinds of rows:
    a posting (segment, term, n, positions) per distinct word of a segment, with little-endian 32-bit positions in the
    segment, and a place (segment, doc_id, base, n_words) per document, with a null term. Words of two documents
    never follow each other: one position lies between them.
    """
    given = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        places: list[tuple] = []
        terms: dict[bytes, int] = {}
        found: list[np.ndarray] = []
        base = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not places:
                return
            codes = np.concatenate([np.empty(0, np.int32), *found])
            at = np.concatenate(
                [np.empty(0, np.int32), *(np.arange(b, b + n, dtype="<i4") for _, b, n in places)]
            )
            order = np.argsort(codes, kind="stable")
            counts = np.bincount(codes, minlength=len(terms))
            offsets = np.append(0, np.cumsum(counts)).astype(np.int32) * 4
            data = at[order].astype("<i4").tobytes()
            k = len(terms)
            lists = pa.BinaryArray.from_buffers(pa.binary(), k, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
            none = pa.nulls(k, pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, number)), pa.array(list(terms), pa.binary()).cast(pa.string()),
                 pa.array(counts, pa.int64()), lists, none, pa.nulls(k, pa.int64())],
                ["segment", "term", "n", "positions", "doc_id", "base"],
            )
            d = len(places)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, number)), pa.nulls(d, pa.string()), pa.array([p[2] for p in places], pa.int64()),
                 pa.nulls(d, pa.binary()), pa.array([p[0] for p in places], pa.string()),
                 pa.array([p[1] for p in places], pa.int64())],
                ["segment", "term", "n", "positions", "doc_id", "base"],
            )

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                words = words_of(text.as_py())
                if places and base + len(words) > SEGMENT_WORDS:
                    yield from flush()
                    number, base = number + 1, 0
                    places, terms, found = [], {}, []
                for w in words:
                    if w not in terms:
                        terms[w] = len(terms)
                found.append(np.fromiter(map(terms.__getitem__, words), np.int32, len(words)))
                places.append((doc_id, base, len(words)))
                base += len(words) + 1
        yield from flush()

    schema = "segment long, term string, n long, positions binary, doc_id string, base long"
    return written(given.mapInArrow(segments, schema), "index", compression="zstd")


def windows_of(items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(window, item_ids) for every distinct run of `size` words of `items` (item_id, text).

    An item of fewer words, but not none, is one window. Null texts have no words; items without an id take no part.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item_id"], batch["text"]):
                words = [w.decode("utf-8", "surrogatepass") for w in words_of(text)]
                for k in range(max(1, len(words) - size + 1) if words else 0):
                    rows.append((item, words[k : k + size]))
            yield pd.DataFrame(rows, columns=["item_id", "window"])

    given = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = given.mapInPandas(cut, "item_id string, window array<string>")
    return cuts.groupBy("window").agg(F.collect_set("item_id").alias("item_ids"))


def _starts(lists: dict[str, np.ndarray], window: list[str], order: list[int]) -> np.ndarray:
    """Where all words of `window` named in `order` stand at their places: offset-adjusted lists, rarest first."""
    found = None
    for k in order:
        here = lists.get(window[k])
        if here is None:
            return np.empty(0, np.int64)
        found = here.astype(np.int64) - k if found is None else found[_held(here, found + k)]
        if not len(found):
            return found
    return found


def _held(places: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of `wanted` are among the sorted `places`, looked up one by one: `places` may be far more."""
    at = np.searchsorted(places, wanted.astype(places.dtype))
    at[at == len(places)] = 0
    return places[at] == wanted if len(places) else np.zeros(len(wanted), bool)


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(segment, window_id, size, starts) of every occurrence of the windows (window_id, window, block) in the index.

    Windows are sent to the tasks block by block. For each window the words are ranked by how often they
    occur in the whole index. Only postings of the `ANCHORS` rarest are read first; where their lists meet, the
    postings of the other words of just those segments are read too and decide.
    """
    spark = index.sparkSession
    postings = index.where("term IS NOT NULL").select("segment", "term", "n", "positions")
    last = windows.agg(F.max("block")).first()[0]
    parts = [spark.createDataFrame([], MATCHES)]
    for number in range(0 if last is None else last + 1):
        block = windows.where(F.col("block") == number).collect()
        if block:
            parts.append(_block_matches(spark, postings, {r["window_id"]: list(r["window"]) for r in block}))
    return reduce(DataFrame.union, parts)


def numbered(windows: DataFrame, most: int | None = None) -> DataFrame:
    """`windows` (distinct) with a window_id each and a block, written. Hashes deal them into blocks of some `most` windows."""
    windows = written(windows, "cuts")
    blocks = ceil(windows.count() / (most or WINDOW_BLOCK)) or 1
    block = F.pmod(F.xxhash64("window"), F.lit(blocks)).cast("int")
    return written(windows.select("*", F.monotonically_increasing_id().alias("window_id"), block.alias("block")), "windows")


def _block_matches(spark, postings: DataFrame, windows: dict[int, list[str]]) -> DataFrame:
    vocabulary = spark.createDataFrame([(t,) for t in {t for w in windows.values() for t in w}], "term string")
    # At most a block's windows times their length.
    counts = dict(postings.join(F.broadcast(vocabulary), "term").groupBy("term").agg(F.sum("n")).collect())
    plans = {
        i: (w, sorted(range(len(w)), key=lambda k: (counts.get(w[k], 0), k)))
        for i, w in windows.items()
        if all(t in counts for t in w)
    }
    anchors = spark.createDataFrame([(t,) for t in {w[k] for w, o in plans.values() for k in o[:ANCHORS]}], "term string")

    def lists_of(batch: pd.DataFrame) -> dict[str, np.ndarray]:
        return {t: np.frombuffer(p, "<i4") for t, p in zip(batch["term"], batch["positions"])}

    by_anchor: dict[str, list[int]] = {}
    for i, (w, order) in plans.items():
        by_anchor.setdefault(w[order[0]], []).append(i)

    def meet(batch: pd.DataFrame) -> pd.DataFrame:
        lists, rows = lists_of(batch), []
        for term in lists.keys() & by_anchor.keys():
            for i in by_anchor[term]:
                w, order = plans[i]
                found = _starts(lists, w, order[:ANCHORS])
                if len(found):
                    rows.append((batch["segment"].iloc[0], i, found.astype(np.int32)))
        return pd.DataFrame(rows, columns=["segment", "window_id", "starts"])

    schema = "segment long, window_id long, starts array<int>"
    met = written(
        postings.join(F.broadcast(anchors), "term").drop("n").groupBy("segment").applyInPandas(meet, schema), "met"
    )
    rest = spark.createDataFrame(
        [(i, [w[k] for k in order[ANCHORS:]]) for i, (w, order) in plans.items()], "window_id long, terms array<string>"
    )
    needed = met.join(F.broadcast(rest), "window_id").select("segment", F.explode("terms").alias("term")).distinct()
    needed = written(needed, "needed")
    # Few postings are needed as a rule. Sent to the tasks if counted to be few, they spare the index a shuffle.
    few = needed.count() <= BROADCAST_ROWS
    others = postings.drop("n").join(F.broadcast(needed) if few else needed, ["segment", "term"])

    def verify(found: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
        lists, rows, none = lists_of(batch), [], np.empty(0, np.int32)
        for segment, i, starts in zip(found["segment"], found["window_id"], found["starts"]):
            w, order = plans[i]
            left = np.asarray(starts, np.int64)
            for k in order[ANCHORS:]:
                left = left[_held(lists.get(w[k], none), left + k)]
                if not len(left):
                    break
            else:
                rows.append((segment, i, len(w), left.astype(np.int32)))
        return pd.DataFrame(rows, columns=["segment", "window_id", "size", "starts"])

    return met.groupBy("segment").cogroup(others.groupBy("segment")).applyInPandas(verify, MATCHES)


def proximity_matches(index: DataFrame, pairs: DataFrame, distance: int) -> DataFrame:
    """(segment, base, doc_id, first, second, places): where `first` stands with `second` at most `distance` words off.

    One row per document, told apart by (segment, base), and pair with matches; `places` are word numbers in the document,
    from 0. Both words stand in the same document; a pair of one word twice asks for another place of it. Words are
    those of the index, in lower case.
    """
    terms = pairs.select(F.explode(F.array("first", "second")).alias("term")).distinct()
    postings = index.where("term IS NOT NULL").select("segment", "term", "positions").join(terms, "term")
    wanted = [(r["first"], r["second"]) for r in pairs.select("first", "second").distinct().collect()]  # the queries
    documents = index.where("term IS NULL").select(
        F.col("segment").alias("segment"), "doc_id", "base", F.col("n").alias("n_words")  # another column than the postings'
    )

    def near(batch: pd.DataFrame, docs_of: pd.DataFrame) -> pd.DataFrame:
        lists = {t: np.frombuffer(p, "<i4").astype(np.int64) for t, p in zip(batch["term"], batch["positions"])}
        docs_of = docs_of.sort_values("base", ignore_index=True)
        bases, ids, rows = docs_of["base"].to_numpy(np.int64), docs_of["doc_id"], []
        stops = bases + docs_of["n_words"].to_numpy(np.int64)
        for a, b in wanted:
            if a in lists and b in lists:
                x, y = lists[a], lists[b]
                own = np.searchsorted(bases, x, "right") - 1
                low = np.searchsorted(y, np.maximum(x - distance, bases[own]))
                high = np.searchsorted(y, np.minimum(x + distance, stops[own] - 1), "right")
                hit = high - low > int(a == b)
                hits, own = x[hit], own[hit]
                found, first = np.unique(own, return_index=True)
                for d, places in zip(found, np.split(hits, first[1:])):
                    rows.append((docs_of["segment"].iloc[0], bases[d], ids[d], a, b, (places - bases[d]).astype(np.int32)))
        return pd.DataFrame(rows, columns=["segment", "base", "doc_id", "first", "second", "places"])

    schema = "segment long, base long, doc_id string, first string, second string, places array<int>"
    return postings.groupBy("segment").cogroup(documents.groupBy("segment")).applyInPandas(near, schema)


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """One row per document of `docs` (doc_id, text): doc_id, n_words, n_hit, item_ids.

    n_hit counts words inside any occurrence of a window of `items`, item_ids the items whose windows occur, as sorted
    strings. Null and empty texts have no words. Repeated rows are rows of their own; repeated items count once.
    Without documents there are no rows, without items no hits. doc_id comes back as it was.
    """
    index = build_index(docs)
    windows = numbered(windows_of(items, size))
    matches = written(phrase_matches(index, windows.select("window_id", "window", "block")), "matches")
    places = index.where("term IS NULL").select("segment", "doc_id", "base", F.col("n").alias("n_words"))

    def cover(found: pd.DataFrame, docs_of: pd.DataFrame) -> pd.DataFrame:
        docs_of = docs_of.sort_values("base", ignore_index=True)
        if not len(docs_of):
            return pd.DataFrame({"doc_id": [], "base": [], "segment": [], "n_hit": [], "windows": []})
        bases = docs_of["base"].to_numpy()
        end = int(bases[-1] + docs_of["n_words"].iloc[-1])
        change = np.zeros(end + 2, np.int32)
        inside: list[set] = [set() for _ in range(len(docs_of))]
        for i, n, starts in zip(found["window_id"], found["size"], found["starts"]):
            starts = np.asarray(starts, np.int64)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + n, -1)
            for d in np.unique(np.searchsorted(bases, starts, "right") - 1):
                inside[d].add(i)
        hit = np.append(0, np.cumsum(np.cumsum(change)[:-1] > 0))
        stops = bases + docs_of["n_words"].to_numpy()
        return pd.DataFrame({
            "segment": docs_of["segment"], "base": bases, "n_hit": hit[stops] - hit[bases],
            "windows": [sorted(x) for x in inside],
        })[lambda d: d["n_hit"] > 0]

    touched = places.join(matches.select("segment").distinct(), "segment")
    hits = matches.groupBy("segment").cogroup(touched.groupBy("segment")).applyInPandas(
        cover, "segment long, base long, n_hit long, windows array<long>"
    )
    hits = written(hits, "hits")
    item_ids = (
        hits.select("segment", "base", F.explode("windows").alias("window_id"))
        .join(windows.select("window_id", "item_ids"), "window_id")
        .select("segment", "base", F.explode("item_ids").alias("item_id"))
        .groupBy("segment", "base").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    kind = docs.schema["doc_id"].dataType
    return (
        places.join(hits.select("segment", "base", "n_hit").join(item_ids, ["segment", "base"]), ["segment", "base"], "left")
        .select(
            F.col("doc_id").cast(kind).alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )
