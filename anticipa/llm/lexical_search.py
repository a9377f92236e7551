"""Ranked lexical search: item weights times document impacts as dense blocks of a matrix product.

Impacts and weights are whole numbers held in doubles. A product of a tile is exact as long as its partial sums stay below
2^53: a weight is below 44,400 (1000 ln(2N + 2) for any N of 63 bits), an impact below 10^6, and a tile has
`VOCABULARY_TILE` = 4096 terms, so sums stay below 1.9 * 10^14. Sums of tiles are added as 64-bit integers.
"""

from collections import Counter
from collections.abc import Iterator
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anticipa.llm import byte_words
from anticipa.session import written

ITEM_TILE, DOCUMENT_TILE, VOCABULARY_TILE = 64, 1024, 4096
BLOCK_TERMS, BLOCK_ITEMS = 1 << 17, 4096  # (item, term) pairs, and items, that are broadcast at a time
_RESULT = "item_id {}, rank int, doc_id long, score long"
_NO_ID = np.iinfo(np.int64).max


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term as bytes) of `items`."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in byte_words.slices(batch):
                found = [set().union(*byte_words.terms(t)) for t in texts]
                at = np.repeat(np.arange(len(found)), [len(f) for f in found])
                flat = pa.array([term for f in found for term in f], pa.binary())
                yield pa.RecordBatch.from_arrays([part["item_id"].take(pa.array(at)), flat], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(split, f"item_id {kind}, term binary").distinct()


def _postings(docs: DataFrame, vocabulary) -> DataFrame:
    """Per document with terms: doc_id, its number of terms, and ids and occurrences of those in `vocabulary`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = vocabulary.value.get
        for batch in batches:
            for part, texts in byte_words.slices(batch):
                sizes, ids, times = [], [], []
                for text in texts:
                    n, held = 0, Counter()
                    for piece in byte_words.terms(text):
                        n += len(piece)
                        held.update(map(find, piece))
                    held.pop(None, None)
                    sizes.append(n)
                    ids.append(np.fromiter(held.keys(), "<i4", len(held)).tobytes())
                    times.append(np.fromiter(held.values(), "<i8", len(held)).tobytes())
                columns = [part["doc_id"], pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(times, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "ids", "times"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id long, n long, ids binary, times binary").where("n > 0")


def _frequencies(postings: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of `size` terms; one row per task and term is shuffled."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch["ids"].to_pylist()), "<i4"), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "df"])

    counted = postings.select("ids").mapInArrow(held, "id long, df long").groupBy("id").agg(F.sum("df").alias("df"))
    df = np.zeros(size, np.int64)
    for row in counted.collect():  # at most BLOCK_TERMS rows, or the terms of one item
        df[row["id"]] = row["df"]
    return df


class _Best:
    """The k best documents of each of some items so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.zeros(items, np.int64)
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, docs: np.ndarray, nulls: np.ndarray) -> None:
        """`scores` is items by documents. Every document that ties with the k-th is compared by its id."""
        least = self.floor
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        item, at = np.nonzero((scores > 0) & (scores >= least[:, None]))
        if not len(item):
            return
        score, doc, null = np.append(self.score, scores[item, at]), np.append(self.doc, docs[at]), np.append(self.null, nulls[at])
        item = np.append(self.item, item)
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        first = np.arange(len(item)) - np.searchsorted(item, item) < self.k
        order = order[first]
        self.item, self.score, self.doc, self.null = item[first], score[order], doc[order], null[order]
        full = np.flatnonzero(np.bincount(self.item, minlength=len(self.floor)) == self.k)
        self.floor[full] = self.score[np.searchsorted(self.item, full, side="right") - 1]


def _tiles(item: np.ndarray, term: np.ndarray, n_items: int, n_terms: int) -> list:
    """Per tile of items, per tile of its own compact vocabulary: items, local ids of all terms (-1: not here), pairs."""
    tiles = []
    for first in range(0, n_items, ITEM_TILE):
        mine = (item >= first) & (item < first + ITEM_TILE)
        own = np.unique(term[mine])
        parts = []
        for k in range(0, len(own), VOCABULARY_TILE):
            local = np.full(n_terms, -1, np.int32)
            local[own[k : k + VOCABULARY_TILE]] = np.arange(len(own[k : k + VOCABULARY_TILE]))
            here = mine & (local[term] >= 0)
            parts.append((local, item[here] - first, term[here]))
        tiles.append((first, min(ITEM_TILE, n_items - first), parts))
    return tiles


def _scored(postings: DataFrame, block, k: int) -> DataFrame:
    """The k best documents of each item among those of one task; see `_Best`."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, term, weight, n_items, documents, length = block.value
        tiles = _tiles(item, term, n_items, len(weight))
        best = [_Best(size, k) for _, size, _ in tiles]
        for batch in batches:
            for start in range(0, batch.num_rows, DOCUMENT_TILE):
                part = batch.slice(start, DOCUMENT_TILE)
                ids, times = part["ids"].to_pylist(), part["times"].to_pylist()
                at = np.repeat(np.arange(len(ids)), [len(i) // 4 for i in ids])
                ids, times = np.frombuffer(b"".join(ids), "<i4"), np.frombuffer(b"".join(times), "<i8")
                m = 100 - 90 + 90 * part["n"].to_numpy() * documents // length
                impact = 1_000_000_000 * times // (1000 * times + 8 * m[at])
                docs = part["doc_id"].fill_null(_NO_ID).to_numpy()
                nulls = part["doc_id"].is_null().to_numpy(zero_copy_only=False)
                for (_, size, parts), top in zip(tiles, best):
                    scores = np.zeros((size, len(docs)), np.int64)
                    for local, rows, terms in parts:
                        held = local[ids] >= 0
                        width = int(local.max()) + 1
                        impacts, weights = np.zeros((width, len(docs))), np.zeros((size, width))
                        impacts[local[ids[held]], at[held]] = impact[held]
                        weights[rows, local[terms]] = weight[terms]
                        scores += (weights @ impacts).astype(np.int64)
                    top.add(scores, docs, nulls)
        for (first, _, _), top in zip(tiles, best):
            columns = [pa.array(top.item + first), pa.array(top.doc, mask=top.null), pa.array(top.score)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return postings.mapInArrow(rank, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The `k` highest-scoring of all `docs` (doc_id, text) for each item of `items` (item_id, text), scores above 0 only.

    Returns item_id, rank (from 1), doc_id, score; equal scores by ascending doc_id, null ids last. Texts are read whole;
    null texts have no terms, and documents without terms count for no statistic. Rows of one item_id (null too) are one
    item with the terms of all of them; every row of `docs` is a document of its own, also under a repeated doc_id. No
    items, no documents or no common term: no rows. Other columns are not looked at.

    Items go in blocks of about `block_terms` (item, term) pairs and `BLOCK_ITEMS` items, drawn by a hash, which bounds what
    is broadcast (one item's own terms always go together); each block passes over all documents once and writes their postings to the shared folder. A task gives at most `k` documents an item.
    """
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    pairs = written(item_terms(items), "item-terms")
    size, n_items = pairs.agg(F.count("*"), F.count_distinct(F.struct("item_id"))).first()
    blocks = max(ceil(size / block_terms), ceil(n_items / BLOCK_ITEMS))
    block_of = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    result = []
    for number in range(blocks):
        rows = pairs.where(block_of == number).collect()  # about block_terms rows, by the choice of blocks
        vocabulary = {term: i for i, term in enumerate(sorted({bytes(r["term"]) for r in rows}))}
        numbers = {item: i for i, item in enumerate(dict.fromkeys(r["item_id"] for r in rows))}
        if not numbers:
            continue
        terms = spark.sparkContext.broadcast(vocabulary)
        postings = written(_postings(docs, terms), "postings", compression="zstd")
        terms.destroy()
        n, length = postings.agg(F.count("*"), F.sum("n")).first()
        if not n:
            break
        df = _frequencies(postings, len(vocabulary))
        weight = np.array([floor(1000 * log((2 * n + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        item = np.array([numbers[r["item_id"]] for r in rows])
        term = np.array([vocabulary[bytes(r["term"])] for r in rows])
        block = spark.sparkContext.broadcast((item, term, weight, len(numbers), n, length))
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = _scored(postings, block, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        ranked = written(ranked, "ranked")
        block.destroy()
        names = spark.createDataFrame([(i, item) for item, i in numbers.items()], f"item long, item_id {kind}")
        result.append(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not result:
        return spark.createDataFrame([], _RESULT.format(kind))
    whole = result[0]
    for more in result[1:]:
        whole = whole.unionByName(more)
    return whole
