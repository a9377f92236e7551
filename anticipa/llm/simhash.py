"""Near-duplicate documents by SimHash fingerprints, compared exactly in tiles."""

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anticipa.llm.common import columns_of
from anticipa.session import written

SHINGLE_WORDS, RADIUS, SEED, TILE_ROWS = 4, 4, 42, 4096
_SHINGLES_AT_ONCE = 50_000
_ROWS_AT_ONCE = 64
BROADCAST_WORDS = 1_000_000
# Column names of our own, which no table of a user has.
_ROW, _BITS, _WORD, _KEPT = (f"anticipa simhash {name}" for name in ("row", "bits", "word", "kept"))


def text_fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of the shingles of `text`; zero if it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    flat = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(stops[:-1] + 1).tolist()]
    n = max(1, len(words) - shingle + 1)
    stops = stops.tolist()[min(shingle, len(words)) - 1 :]
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, _SHINGLES_AT_ONCE):
        spans = zip(starts[k : min(n, k + _SHINGLES_AT_ONCE)], stops[k : k + _SHINGLES_AT_ONCE])
        hashes = np.array([digest(flat[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """`text_fingerprint` as a long of the same 64 bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = np.array([text_fingerprint(t, shingle) for t in texts], "<u8")
        return pd.Series(found.view("<i8"))

    return of(text)


def tile_links(x: np.ndarray, y: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links that join all values of x and y within `radius` bits of each other, by way of others in these tiles.

    `y` is None to compare x with itself. A spanning forest: fewer links than values, however many pairs are close.
    """
    same = y is None
    x = x.view(np.uint64)  # the bits of a signed value are not counted, but those of its amount
    y = x if same else y.view(np.uint64)
    shift = 0 if same else len(x)
    values = x if same else np.concatenate([x, y])
    signed = values.view(np.int64)
    label = np.arange(len(values))
    links = []
    for k in range(0, len(x), _ROWS_AT_ONCE):
        close = np.bitwise_count(x[k : k + _ROWS_AT_ONCE, None] ^ y[None, :]) <= radius
        for i in np.flatnonzero(close.sum(axis=1) > same):
            near = np.unique(label[np.append(np.flatnonzero(close[i]) + shift, k + i)])
            if len(near) > 1:
                links += [(int(signed[other]), int(signed[near[0]])) for other in near[1:]]
                label[np.isin(label, near)] = near[0]
    return links


def near_links(values: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) between the distinct longs of `values.fingerprint` that join all pairs within `radius` bits.

    A tile holds about `tile_rows` values of one bit count. Two tiles are compared, every value with every other, unless
    their bit counts differ by more than `radius`. Work grows with the square of the distinct values, as the
    method has it; a group of close values gives each tile pair fewer links than values.
    """
    spark = values.sparkSession
    counts = dict(values.groupBy(F.bit_count("fingerprint").alias("bits")).count().collect())  # 65 rows at most
    if not counts:
        return spark.createDataFrame([], "a long, b long")
    tiles_of = {p: ceil(n / tile_rows) for p, n in counts.items()}
    n_tiles = F.create_map(*(F.lit(v) for p, n in tiles_of.items() for v in (int(p), int(n))))
    bits = F.bit_count("fingerprint")
    tiles = values.groupBy(
        bits.alias("bits"), F.pmod(F.xxhash64("fingerprint"), n_tiles[bits]).cast("int").alias("part")
    ).agg(F.sort_array(F.collect_list("fingerprint")).alias("rows"))
    tiles = written(tiles, "tiles")

    pairs = sum(
        n * tiles_of.get(q, 0) for p, n in tiles_of.items() for q in range(p, p + radius + 1)
    )
    right = (
        tiles.select("bits", "part", F.explode(F.sequence("bits", F.col("bits") + radius)).alias("bits2"))
        .where(n_tiles[F.col("bits2")].isNotNull())
        .select("bits", "part", "bits2", F.explode(F.sequence(F.lit(0), n_tiles[F.col("bits2")] - 1)).alias("part2"))
        .where("bits2 > bits OR part2 >= part")
    )
    both = (
        right.join(tiles, ["bits", "part"])
        .withColumnRenamed("rows", "x")
        .join(tiles.select(F.col("bits").alias("bits2"), F.col("part").alias("part2"), F.col("rows").alias("y")),
              ["bits2", "part2"])
        .select((F.struct("bits", "part") == F.struct("bits2", "part2")).alias("same"), "x", "y")
        .repartition(max(1, ceil(pairs / 8)), F.xxhash64("bits", "part", "bits2", "part2"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same, x, y in zip(batch["same"], batch["x"], batch["y"]):
                x, y = (v.values.to_numpy(zero_copy_only=False).astype(np.int64) for v in (x, y))
                links = tile_links(x, None if same.as_py() else y, radius)
                if links:
                    a, b = zip(*links)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return both.mapInArrow(compare, "a long, b long")


def _marks(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): for every node of `links` (a, b) the smallest node that can be reached from it.

    Large-star and small-star steps in turn until nothing changes; each step is a few aggregates and joins and is
    written to the shared folder, so that a lost executor costs one step at most.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = written(links, "links")
    marks = _marks(links)
    while marks[0]:
        # Large star: every larger neighbour goes to the smallest one.
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: every smaller neighbour, and the node itself, goes to the smallest one.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        links = written(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        old, marks = marks, _marks(links)
        if marks == old:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select("b", "b").distinct()
    )


def near_groups(
    docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS, tile_rows: int = TILE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of `docs` (doc_id, text), one row each, and the group of every distinct fingerprint.

    Returns rows (doc_id, fingerprint) and groups (fingerprint, group_key, component_id). component_id is the smallest
    doc_id of the group, null if none has one. Null and blank texts have fingerprint zero and are linked like others.
    Repeated rows and copies share one fingerprint, which is compared once. No documents: no rows.
    """
    rows = written(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fingerprint")), "fingerprints")
    return rows, groups_of(rows, radius, tile_rows)


def groups_of(rows: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(fingerprint, group_key, component_id) of every distinct fingerprint of `rows` (doc_id, fingerprint)."""
    distinct = written(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct")
    grouped = components(near_links(distinct.select("fingerprint"), radius, tile_rows))
    keyed = distinct.join(grouped, distinct.fingerprint == grouped.node, "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("group_key")
    )
    keyed = written(keyed, "keyed")
    smallest = keyed.groupBy("group_key").agg(F.min("first_id").alias("component_id"))
    return keyed.drop("first_id").join(smallest, "group_key").select("fingerprint", "group_key", "component_id")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id. See `near_groups`."""
    rows, groups = near_groups(docs, **options)
    return rows.join(groups, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """`docs` with one document of each near-duplicate group: one with the group's smallest doc_id.

    Of several rows under that doc_id the one with the smallest fingerprint (as a signed long) and then the smallest
    text digest stays, and of rows that are equal in all three any one. Only ids, fingerprints and digests are shuffled to
    find it; texts are read once for their fingerprint and once to be kept, and move no further (see `_kept_rows`).
    """
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    marked = written(
        docs.withColumns({_ROW: F.monotonically_increasing_id(), _BITS: fingerprint(F.col("text"), options.get("shingle", SHINGLE_WORDS))}),
        "marked",
        compression="zstd",
    )
    rows = marked.select("doc_id", F.col(_BITS).alias("fingerprint"), digest.alias("digest"), F.col(_ROW).alias("row"))
    groups = groups_of(rows, options.get("radius", RADIUS), options.get("tile_rows", TILE_ROWS))
    mine = rows.join(groups, "fingerprint").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = mine.groupBy("group_key").agg(F.min(F.struct("fingerprint", "digest", "row")).alias("least"))
    return _kept_rows(marked, first.select(F.col("least.row").alias("row"))).select(*columns_of(docs))


def _kept_rows(marked: DataFrame, kept: DataFrame, most: int = BROADCAST_WORDS) -> DataFrame:
    """The rows of `marked` whose number is in `kept` (row).

    The numbers are sent to the tasks as words of 64 bits, one bit a row, so that `marked` is not shuffled. Beyond `most`
    words, counted first, Spark joins the two as it sees fit.
    """
    bit = F.expr("shiftleft(1L, CAST(row % 64 AS INT))")
    words = kept.groupBy(F.shiftright("row", 6).alias(_WORD)).agg(F.bit_or(bit).alias(_KEPT))
    words = written(words, "kept")
    few = words.count() <= most
    found = marked.join(F.broadcast(words) if few else words, F.shiftright(_ROW, 6) == F.col(_WORD))
    return found.where(F.getbit(F.col(_KEPT), (F.col(_ROW) % 64).cast("int")) == 1)
