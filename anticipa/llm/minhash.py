"""Near-duplicate documents by MinHash bands, verified batch by batch of their signatures and then exactly.

1. Every text gets its set of distinct word shingles (as 64-bit hashes, XXH64 of words mixed) and a signature of `HASHES`
   least values, of which 16 bits are kept. Equal texts are one node from here on.
2. Nodes whose signatures agree in a band are candidates. In each bucket every node meets the bucket's first node: as many
   pairs as nodes. Where the other nodes of a bucket are not in one group after that, they are compared in tiles, only
   across groups, and no pair is put out: first the nodes with a passing pair are marked, then tiles of those, with
   their full sets, give links that join the groups, at most one per group.
3. Candidates are compared in batches of signature values. After n values of which m agree, the similarity has the
   posterior Beta(m + 1, n - m + 1); a pair goes as soon as the similarity is `THRESHOLD` or more with a probability below
   `MISS`. Survivors are verified on their full sets.

A pair of similarity s shares no band with probability (1 - s^5)^26: below 3e-7 at 0.85 and falling fast above.
"""

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anticipa.llm import byte_words
from anticipa.llm.simhash import components
from anticipa.session import written

SHINGLE_WORDS, THRESHOLD, MISS = 3, 85, 1e-9
BANDS, BAND_ROWS, BATCH = 26, 5, 13
HASHES = BANDS * BAND_ROWS
TILE_ROWS, TILE_SHINGLES = 1024, 2_000_000
BROADCAST_ROWS = 2_000_000  # of 24 bytes; more are joined by shuffling
_SEED = 13
_SHINGLES_AT_ONCE = 16_384


def _mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):  # fixed values: a public finaliser's factors
        values = (values ^ (values >> np.uint64(33))) * np.uint64(factor)
    return values ^ (values >> np.uint64(33))


@lru_cache
def _factors(n: int, seed: int) -> np.ndarray:
    """`n` odd factors."""
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes | None, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of `shingle` words; of the whole sequence if it is shorter; empty without words."""
    parts, carry = [], np.zeros(0, np.uint64)
    factors = _factors(shingle, _SEED)
    for piece in byte_words.words(text):
        hashes = np.concatenate([carry, np.fromiter(map(xxhash.xxh64_intdigest, piece), np.uint64, len(piece))])
        n = len(hashes) - shingle + 1
        if n > 0:
            parts.append(np.unique(_mixed(sum(hashes[i : i + n] * factors[i] for i in range(shingle)))))
            carry = hashes[n:]
        else:
            carry = hashes
    if parts:
        return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
    if not len(carry):
        return carry
    return _mixed((carry * factors[: len(carry)]).sum(keepdims=True) + np.uint64(len(carry)))


def signatures(sets: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """One row of `hashes` 16-bit values per set; all sets must have members."""
    found = np.empty((len(sets), hashes), "<u2")
    factors = _factors(hashes, _SEED + 1)
    first = 0
    while first < len(sets):
        last, size = first + 1, len(sets[first])
        while last < len(sets) and size + len(sets[last]) <= _SHINGLES_AT_ONCE:
            size += len(sets[last])
            last += 1
        values = sets[first] if last == first + 1 else np.concatenate(sets[first:last])
        starts = np.cumsum([0, *(len(s) for s in sets[first : last - 1])])
        product = np.empty_like(values)
        for k in range(hashes):
            np.multiply(values, factors[k], out=product)
            found[first:last, k] = np.minimum.reduceat(product, starts) >> np.uint64(32) & np.uint64(0xFFFF)
        first = last
    return found


def least_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest agreements of `n` at which the similarity may still be `threshold`: posterior probability `miss` or more."""
    # P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n + 1


@lru_cache
def _bounds(hashes: int, threshold: int, miss: float) -> list[tuple[int, int]]:
    return [(n, least_matches(n, threshold / 100, miss)) for n in range(BATCH, hashes + 1, BATCH)]


def passing(x: np.ndarray, y: np.ndarray, threshold: int = THRESHOLD, miss: float = MISS) -> np.ndarray:
    """Numbers of the rows at which the signatures x and y stay above the posterior bound, batch after batch."""
    left, agree = np.arange(len(x)), np.zeros(len(x), np.int64)
    for n, least in _bounds(x.shape[1], threshold, miss):
        agree += (x[left, n - BATCH : n] == y[left, n - BATCH : n]).sum(axis=1)
        keep = agree >= least
        left, agree = left[keep], agree[keep]
    return left


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), HASHES)


def _similar_sizes(a: Column, b: Column, threshold: int) -> Column:
    """Sets of too different sizes cannot be that similar."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold


def _sets(docs: DataFrame, shingle: int, hashes: int) -> DataFrame:
    """(doc_id, key, n_shingles, signature) per document; key is the text's digest, the signature of an empty set is null."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in byte_words.slices(batch):
                sets = [shingle_set(t, shingle) for t in texts]
                signed = iter(signatures([s for s in sets if len(s)], hashes))
                columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array([next(signed).tobytes() if len(s) else None for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["key"], *columns], ["doc_id", "key", "n_shingles", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", _key().alias("key"), "text")
    return rows.mapInArrow(sign, f"doc_id {kind}, key binary, n_shingles long, signature binary")


def _key() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def _full_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of the nodes in `wanted` (node), from the texts of `docs`, written."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in byte_words.slices(batch):
                sets = pa.array([shingle_set(t, shingle).tobytes() for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([part["node"], sets], ["node", "shingles"])

    keys = written(wanted.join(nodes.select("node", "key"), "node"), "wanted")
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    found = docs.select(_key().alias("key"), "text").join(keys, "key").select("node", "text")
    # Copies of one text meet here; they are reduced to one in each task before anything is shuffled.
    sets = found.mapInArrow(hashed, "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))
    return written(sets, "sets")


def _similar(x: np.ndarray, y: np.ndarray, threshold: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= threshold * (len(x) + len(y) - common)


def _exact_links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """Those of `pairs` (a, b) whose full sets are similar enough."""
    sets = _full_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, docs, shingle)
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ((np.frombuffer(v.as_buffer(), "<u8") for v in pair) for pair in zip(batch["x"], batch["y"]))
            linked = pa.array([_similar(x, y, threshold) for x, y in sets], pa.bool_())
            yield batch.select(["a", "b"]).filter(linked)

    return both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def _likely(pairs: DataFrame, nodes: DataFrame, threshold: int, miss: float) -> DataFrame:
    """Those of `pairs` (a, b) whose signatures pass batch after batch."""
    sides = [nodes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("signature").alias(f"s_{s}")) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").where(_similar_sizes(F.col("n_a"), F.col("n_b"), threshold))

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left = passing(_matrix(batch["s_a"]), _matrix(batch["s_b"]), threshold, miss)
                yield batch.select(["a", "b"]).take(pa.array(left))

    return both.select("a", "b", "s_a", "s_b").mapInArrow(prune, "a long, b long")


def tile_pairs(x, y, band: int, threshold: int, miss: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of tile x and of tile y (x itself: None) in different groups that pass, and agree in no band before `band`.

    A tile is (groups, set sizes, signatures). Also gives in how many signature values the pairs agree.
    """
    same = y is None
    y = x if same else y
    (gx, nx, sx), (gy, ny, sy) = x, y
    open_ = (gx[:, None] != gy[None, :]) & (np.minimum(nx[:, None], ny) * 100 >= np.maximum(nx[:, None], ny) * threshold)
    if same:
        open_ &= np.arange(len(gx))[:, None] < np.arange(len(gy))[None, :]
    found = [np.zeros((3, 0), np.int64)]
    if open_.any():
        agree = np.zeros(open_.shape, np.uint8)
        for k in range(BATCH):
            agree += sx[:, k, None] == sy[None, :, k]
        i, j = np.nonzero(open_ & (agree >= _bounds(sx.shape[1], threshold, miss)[0][1]))
        for k in range(0, len(i), 65_536):  # pairs left after the first batch, some at a time
            a, b = sx[i[k : k + 65_536]], sy[j[k : k + 65_536]]
            left = passing(a, b, threshold, miss)
            equal = a[left] == b[left]
            first = equal.reshape(len(left), a.shape[1] // BAND_ROWS, BAND_ROWS).all(axis=2).argmax(axis=1) == band
            found.append(np.array([i[k + left[first]], j[k + left[first]], equal[first].sum(axis=1)]))
    return tuple(np.concatenate(found, axis=1))


def group_links(pairs, x, y, threshold: int) -> list[tuple[int, int]]:
    """Numbers of `pairs` that are linked and join groups that earlier ones have not joined; the most alike come first.

    `pairs` is what `tile_pairs` gives; x and y are (groups, sets).
    """
    i, j, agree = pairs
    group: dict[int, int] = {}

    def top(g: int) -> int:
        while g in group:
            g = group[g]
        return g

    links = []
    for k in np.argsort(-agree, kind="stable").tolist():
        a, b = top(int(x[0][i[k]])), top(int(y[0][j[k]]))
        if a != b and _similar(x[1][i[k]], y[1][j[k]], threshold):
            links.append(k)
            group[max(a, b)] = min(a, b)
    return links


def _tile_pairs_of(rows: DataFrame, tile_rows: int, *columns: str) -> DataFrame:
    """Every pair of tiles (band, x, y) of each bucket; y is null where a tile meets itself.

    `rows` is (bucket, band, node, group, n_shingles, signature and `columns`). A tile has about `tile_rows` rows, and about
    `TILE_SHINGLES` shingles if those are among its columns.
    """
    size = F.count("*") / tile_rows
    if "shingles" in columns:
        size = F.greatest(size, F.sum("n_shingles") / TILE_SHINGLES)
    parts = rows.groupBy("bucket").agg(F.ceil(size).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    tiles = rows.join(parts, "bucket").groupBy("bucket", "band", "parts", part.alias("part")).agg(
        F.collect_list(F.struct("node", "group", "n_shingles", "signature", *columns)).alias("rows")
    )
    tiles = written(tiles, "minhash-tiles")
    left = tiles.select("bucket", "band", "part", F.col("rows").alias("x"), F.explode(F.expr("sequence(part, parts - 1)")).alias("other"))
    right = tiles.select("bucket", F.col("part").alias("other"), F.col("rows").alias("y"))
    alone = F.col("part") == F.col("other")
    nothing = F.lit(None).cast(right.schema["y"].dataType)
    return left.where(~alone).join(right, ["bucket", "other"]).select("bucket", "band", "x", "y").unionByName(
        left.where(alone).select("bucket", "band", "x", nothing.alias("y"))
    )


def _arrays(tile: pa.Scalar):
    fields = tile.values
    node, group, size = (fields.field(name).to_numpy() for name in ("node", "group", "n_shingles"))
    return fields, node, (group, size, _matrix(fields.field("signature")))


def _across_groups(rest: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, tile_rows: int, threshold: int, miss: float) -> DataFrame:
    """Links (a, b) that join the groups of `rest` (bucket, band, node, group) wherever nodes of one bucket are linked.

    Of the links between two groups that a task finds only the first is put out.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, band, x, y in zip(batch["bucket"].to_pylist(), batch["band"].to_pylist(), batch["x"], batch["y"]):
                _, nodes_x, x = _arrays(x)
                _, nodes_y, y = _arrays(y) if y.is_valid else (None, nodes_x, None)
                i, j, _ = tile_pairs(x, y, band, threshold, miss)
                marked = np.union1d(nodes_x[i], nodes_y[j])
                yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(marked), pa.int64()), pa.array(marked, pa.int64())], ["bucket", "node"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for band, *both in zip(batch["band"].to_pylist(), batch["x"], batch["y"]):
                found = [_arrays(tile) for tile in both if tile.is_valid]
                pairs = tile_pairs(found[0][2], found[1][2] if len(found) > 1 else None, band, threshold, miss)
                sides = [(tile[0], [np.frombuffer(s.as_buffer(), "<u8") for s in fields.field("shingles")]) for fields, _, tile in found]
                left = group_links(pairs, sides[0], sides[-1], threshold)
                ends = [pa.array(found[side][1][rows[left]], pa.int64()) for side, rows in ((0, pairs[0]), (-1, pairs[1]))]
                yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    mixed = rest.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("bucket")
    signed = nodes.select("node", "n_shingles", "signature")
    rows = rest.join(mixed, "bucket").join(signed, "node")
    marked = _tile_pairs_of(rows, tile_rows).mapInArrow(mark, "bucket long, node long").distinct()
    marked = written(marked, "marked")
    sets = _full_sets(marked.select("node").distinct(), nodes, docs, shingle)
    rows = rest.join(marked, ["bucket", "node"]).join(signed, "node").join(sets, "node")
    return _tile_pairs_of(rows, tile_rows, "shingles").select("band", "x", "y").mapInArrow(link, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE_WORDS, threshold: int = THRESHOLD, miss: float = MISS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """One row per document of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * common >= `threshold` * all of their distinct shingles, and equal texts always; without
    a word a document is linked with nothing. component_id is the smallest doc_id that links reach, its own included;
    null only if the whole group has no id, or a document without words none. kept marks the rows of that id.
    Repeated rows are linked like copies. Texts are read whole. No documents: no rows. Other columns are not looked at.
    """
    rows = written(_sets(docs, shingle, HASHES), "minhash-rows", compression="zstd")
    whole = rows.where("n_shingles > 0")
    nodes = whole.groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes", compression="zstd")
    width = 2 * BAND_ROWS
    bands = nodes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")).select(
        "node", "band", F.expr(f"xxhash64(band, substring(signature, {width} * band + 1, {width}))").alias("bucket")
    )
    firsts = bands.groupBy("bucket").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1")
    stars = written(bands.join(firsts, "bucket").where("node <> first"), "stars")

    pairs = stars.select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    likely = written(_likely(pairs, nodes, threshold, miss), "likely")
    links = written(_exact_links(likely, nodes, docs, shingle, threshold), "near-links")
    grouped = written(components(links), "near-groups")

    own = F.coalesce("component", F.col("node")).alias("group")
    rest = stars.where("n > 2").select("bucket", "band", "node").join(grouped, "node", "left").select("bucket", "band", "node", own)
    more = written(_across_groups(written(rest, "rest"), nodes, docs, shingle, tile_rows, threshold, miss), "more-links")
    if not more.isEmpty():
        grouped = written(components(links.unionByName(more)), "near-groups")

    named = nodes.select("node", "key", "first_id").join(grouped, "node", "left").withColumn("group", own)
    least = named.groupBy("group").agg(F.min("first_id").alias("component_id"))
    found = named.join(least, "group").select("key", "component_id")
    alone = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(found, "key", "left").select("doc_id", "n_shingles", alone.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
