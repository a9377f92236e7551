"""Documents drawn by importance: n-gram buckets weighed by their share in a target corpus against the source corpus."""

import zlib
from collections.abc import Iterator
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anticipa.llm import byte_words
from anticipa.session import written

RUN_WORDS, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
_GRAMS_AT_ONCE = 200_000
_ROWS_PER_RANGE = 250_000


class Interned:
    """Distinct n-grams of one batch in an open-addressed table of NumPy arrays.

    A gram's slot is found from its XXH64 by linear probing, all grams of the batch at once; equal keys are taken for the
    same gram only if their bytes are equal too. `slot` is the slot of every occurrence; `bucket` and `count` belong to
    slots. The table is at most half full and lives as long as its batch.
    """

    def __init__(self, grams: list[bytes], buckets: int, digest=xxhash.xxh64_intdigest):
        n = len(grams)
        size = 1 << max(4, (2 * n).bit_length())
        keys = np.fromiter(map(digest, grams), np.uint64, n)
        texts = np.fromiter(grams, object, n)
        place = (keys & np.uint64(size - 1)).astype(np.int64)
        holder = np.full(size, -1, np.int64)
        self.slot = np.empty(n, np.int64)
        left = np.arange(n)
        while len(left):
            at = place[left]
            free = holder[at] < 0
            holder[at[free]] = left[free]  # of several that reach a free slot at once, one holds it
            held = holder[at]
            same = keys[held] == keys[left]
            same[same] = texts[held[same]] == texts[left[same]]
            self.slot[left[same]] = at[same]
            left = left[~same]
            place[left] = (place[left] + 1) & (size - 1)
        self.used = np.flatnonzero(holder >= 0)
        self.bucket = np.zeros(size, np.int64)
        self.bucket[self.used] = [zlib.crc32(texts[i]) % buckets for i in holder[self.used]]
        self.count = np.bincount(self.slot, minlength=size)


def _grams(texts: list[bytes | None], run_words: int) -> Iterator[tuple[list[bytes], list[int], list[int], list[int]]]:
    """All runs of 1 to `run_words` words, some 200,000 at a time: the grams, and the rows they are of as (row, words, grams)."""
    grams: list[bytes] = []
    rows, words_of, grams_of = [], [], []
    for row, text in enumerate(texts):
        before: list[bytes] = []
        for piece in byte_words.terms(text):
            whole, old, start = before + piece, len(before), len(grams)
            grams += piece
            for length in range(2, run_words + 1):
                stops = range(max(old, length - 1), len(whole))
                grams += [b" ".join(whole[stop - length + 1 : stop + 1]) for stop in stops]
            before = whole[len(whole) - run_words + 1 :] if run_words > 1 else []
            rows.append(row)
            words_of.append(len(piece))
            grams_of.append(len(grams) - start)
            if len(grams) >= _GRAMS_AT_ONCE:
                yield grams, rows, words_of, grams_of
                grams, rows, words_of, grams_of = [], [], [], []
    if rows:
        yield grams, rows, words_of, grams_of


def bucket_counts(docs: DataFrame, run_words: int = RUN_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all `docs` (text) fall into each bucket. At most `buckets` rows a task are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in byte_words.slices(batch):
                for grams, *_ in _grams(texts, run_words):
                    table = Interned(grams, buckets)
                    np.add.at(total, table.bucket[table.used], table.count[table.used])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(buckets, np.int64)
    for row in counted.collect():  # `buckets` rows at most
        found[row["bucket"]] = row["n"]
    return found


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the target's share to the source's per bucket, in thousandths rounded down, smoothed by one each."""
    s_all, t_all, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array(
        [floor(1000 * log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def weights(docs: DataFrame, gains: np.ndarray, run_words: int = RUN_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_features, and weight, the sum of its features' gains."""
    buckets, spark = len(gains), docs.sparkSession
    shared = spark.sparkContext.broadcast(gains)  # as many numbers as there are buckets

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = shared.value
        for batch in batches:
            for part, texts in byte_words.slices(batch):
                n_words, n_grams, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
                for grams, rows, words_of, grams_of in _grams(texts, run_words):
                    table = Interned(grams, buckets)
                    gathered = gains[table.bucket][table.slot]
                    sums = np.concatenate([[0], np.cumsum(gathered)])
                    stops = np.cumsum(grams_of, dtype=np.int64)
                    np.add.at(weight, rows, sums[stops] - sums[stops - np.array(grams_of, np.int64)])
                    np.add.at(n_words, rows, words_of)
                    np.add.at(n_grams, rows, grams_of)
                columns = [part["doc_id"], pa.array(n_words), pa.array(n_grams), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel variate in thousandths, rounded down, fixed by `seed` and the id. A null id counts as an empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def ranked(rows: DataFrame, draw: int, size: int, rows_per_range: int = _ROWS_PER_RANGE) -> DataFrame:
    """(row, rank) of the first `draw` of `rows` (row, doc_id, score; `size` of them) by score, then id (null last).

    Rows are cut into ranges of that order, as even as Spark's sampling makes them; rank is the number of rows in earlier
    ranges plus the place in the own one. `row` tells rows apart that are equal in both, so that they are cut as well.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    parts = max(1, ceil(size / rows_per_range))
    cut = written(rows.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over one row per range
    starts = cut.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    drawn = cut.join(starts.where(F.col("start") < draw), "range")
    return drawn.select("row", (F.col("start") + place).alias("rank")).where(F.col("rank") <= draw)


def resample(
    docs: DataFrame, target: DataFrame, run_words: int = RUN_WORDS, buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """Every document of `docs` (doc_id, text) with its importance for the corpus `target` (text), and the rank of those drawn.

    Returns doc_id, n_words, n_features, weight, score, rank. Drawn without replacement are `percent` of a hundred documents
    that have at least `least_words` words (rounded down), those of the highest score; equal scores go by smaller
    doc_id, null ids last, repeated rows each count. The others' rank is null. Counts cover whole texts of all rows; null
    and empty texts have no features and weight 0. No documents: no rows; an empty target: all its counts are 0.
    """
    gains = bucket_gains(bucket_counts(docs, run_words, buckets), bucket_counts(target, run_words, buckets))
    scored = weights(docs, gains, run_words).withColumns(
        {"score": F.col("weight") + noise(F.col("doc_id"), seed), "row": F.monotonically_increasing_id()}
    )
    scored = written(scored, "importance")
    able = scored.where(F.col("n_words") >= least_words).select("row", "doc_id", "score")
    size = able.count()
    ranks = ranked(able, size * percent // 100, size)
    return scored.join(ranks, "row", "left").select(
        "doc_id", "n_words", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank")
    )
