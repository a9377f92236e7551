"""Packing of documents into training sequences by cutting-stock column generation."""

from math import ceil

import numpy as np
import pandas as pd
import zlib
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anticipa.llm.common import running_total
from anticipa.llm.tokens import id_bytes, id_width
from anticipa.session import written

CAPACITY, GRAIN = 4096, 64
_BLOCK = 2 * CAPACITY


def _best_pattern(prices: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the multiset of classes 1..units (sizes) of at most `units` in all with the best price."""
    best, choice = np.zeros(units + 1), np.zeros(units + 1, int)
    for room in range(1, units + 1):
        offers = best[room - 1 :: -1][:room] + prices[:room]  # class c leaves room - c
        c = int(np.argmax(offers))
        best[room], choice[room] = (offers[c], c + 1) if offers[c] > best[room - 1] else (best[room - 1], 0)
    pattern, room = np.zeros(units), units
    while room > 0:
        c = choice[room]
        if c:
            pattern[c - 1] += 1
        room -= c or 1
    return float(best[units]), pattern


def stock_patterns(demand: np.ndarray, rounds: int = 5000) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often to use each, from the linear program over patterns of length classes.

    `demand[c - 1]` counts the items of size c; a pattern's sizes sum to len(demand) at most. Columns are priced by the
    knapsack under the program's duals until none improves it. The fractional uses are rounded down, so no class
    is used more often than there are items. After `rounds` columns the program in hand is used, which is feasible too.
    """
    units = len(demand)
    basis = np.diag([float(units // c) for c in range(1, units + 1)])
    use = demand / np.diag(basis)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(units))
        value, pattern = _best_pattern(prices, units)
        if value <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, pattern)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, use / step, np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        basis[:, leave] = pattern
        use = np.maximum(np.linalg.solve(basis, demand), 0)
    found = [(basis[:, k].round().astype(int), int(use[k] + 1e-6)) for k in range(units)]
    spent = sum((p * n for p, n in found), np.zeros(units, int))
    assert (spent <= demand).all()
    return [(p, n) for p, n in found if n]


def token_table(docs: DataFrame, path: str, end_id: int | None) -> DataFrame:
    """(row, doc_id, doc_tokens, ids) of every document, written to the shared folder; `row` numbers the rows."""
    width = id_width(path)
    ids = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", id_bytes(F.col("text"), path, end_id).alias("ids"))
    return written(
        ids.select("row", "doc_id", F.expr(f"CAST(octet_length(ids) DIV {width} AS BIGINT)").alias("doc_tokens"), "ids"),
        "tokens",
        compression="zstd",
    )


def _powers(n: int) -> list[int]:
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


def pack_lengths(items: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """Pieces (row, start, length, sequence_id, offset) of `items` (row, doc_tokens), a written table.

    1. Whole stretches of `capacity` of long items are sequences of their own.
    2. What is left of each item has a length class of `grain` tokens. `stock_patterns` over the histogram of
       classes says which classes share a sequence. The items of a class are ranked, and ranks go to patterns.
    3. Items beyond the rounded patterns are cut to fill what room the others leave, then further whole sequences.
       The last tokens, fewer than `capacity`, go to sequences whose lengths are powers of two.
    So no sequence is padded. Every token is in exactly one piece. The histogram, one row a class, and the patterns, no
    more than classes, are all that the driver sees.
    """
    spark, classes = items.sparkSession, capacity // grain
    rest = items.select(
        "row",
        F.expr(f"doc_tokens DIV {capacity}").alias("blocks"),
        (F.col("doc_tokens") % capacity).alias("rest"),
    )
    rest = written(rest.withColumn("class", F.ceil(F.col("rest") / grain).cast("int")), "rest")
    histogram = rest.where("rest > 0").groupBy("class").agg(F.count("*").alias("n"), F.sum("rest").alias("t")).collect()
    demand, tokens = np.zeros(classes), np.zeros(classes)
    for row in histogram:
        demand[row["class"] - 1], tokens[row["class"] - 1] = row["n"], row["t"]
    total = int(tokens.sum())
    full, tail = divmod(total, capacity)

    # Fullest patterns first, no more than the tokens can fill: the others' items fill the room that these leave.
    mean = np.divide(tokens, demand, out=np.zeros(classes), where=demand > 0)
    patterns = sorted(stock_patterns(demand), key=lambda p: (-float(p[0] @ mean), p[0].tolist())) if total else []
    used, next_rank, shares = 0, np.zeros(classes, int), []
    for pattern, times in patterns:
        times = min(times, full - used)
        for c in np.flatnonzero(pattern) if times else []:
            shares.append((int(c) + 1, int(next_rank[c]), int(next_rank[c] + times * pattern[c]), int(pattern[c]), used))
            next_rank[c] += times * pattern[c]
        used += times
    share = spark.createDataFrame(shares, "class int, low long, high long, times long, first long")

    ranked = running_total(rest.where("rest > 0"), ["class"], "row", F.lit(1), "rank")
    placed = ranked.join(
        F.broadcast(share.withColumnRenamed("class", "_class")),  # a row per pattern and class: classes squared at most
        (F.col("class") == F.col("_class")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
        "left",
    ).select("row", "blocks", "rest", F.expr("first + (rank - low) DIV times").alias("sequence_id"))
    placed = written(placed, "placed")

    before = Window.partitionBy("sequence_id").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    whole = placed.where("sequence_id IS NOT NULL").select(
        "row", (F.col("blocks") * capacity).alias("start"), F.col("rest").alias("length"), "sequence_id",
        F.coalesce(F.sum("rest").over(before), F.lit(0)).alias("offset"),
    )

    rooms = placed.where("sequence_id IS NOT NULL").groupBy("sequence_id").agg(F.sum("rest").alias("at"))
    rooms = written(rooms.where(F.col("at") < capacity).withColumn("room", capacity - F.col("at")), "rooms")
    room_sum = rooms.agg(F.sum("room")).first()[0] or 0
    rooms = running_total(rooms, [], "sequence_id", F.col("room"), "low")
    more = spark.range(used, full).select(
        F.col("id").alias("sequence_id"), F.lit(0).cast("long").alias("at"), F.lit(capacity).cast("long").alias("room"),
        (room_sum + (F.col("id") - used) * capacity).alias("low"),
    )
    ends, at = [], total - tail - (used * capacity - room_sum)
    ends = [(full + k, 0, p, at + sum(_powers(tail)[:k])) for k, p in enumerate(_powers(tail))]
    more = more.union(spark.createDataFrame(ends, "sequence_id long, at long, room long, low long"))
    rooms = rooms.select("sequence_id", "at", "room", "low").union(more)

    filler = written(placed.where("sequence_id IS NULL").select("row", "blocks", "rest"), "filler")
    filler = running_total(filler, [], "row", F.col("rest"), "from").withColumn("to", F.col("from") + F.col("rest"))
    rooms = rooms.withColumn("high", F.col("low") + F.col("room"))

    def by_block(df: DataFrame, low: str, high: str) -> DataFrame:
        blocks = F.sequence(F.expr(f"`{low}` DIV {_BLOCK}"), F.expr(f"(`{high}` - 1) DIV {_BLOCK}"))
        return df.withColumn("block", F.explode(blocks))

    cut = F.greatest("from", "low")
    cuts = (
        by_block(filler, "from", "to")
        .join(by_block(rooms, "low", "high"), "block")
        .where((F.col("from") < F.col("high")) & (F.col("low") < F.col("to")))
        .withColumn("cut", cut)
        .where(F.expr(f"cut DIV {_BLOCK}") == F.col("block"))  # neighbours that share two blocks meet once
        .select(
            "row",
            (F.col("blocks") * capacity + F.col("cut") - F.col("from")).alias("start"),
            (F.least("to", "high") - F.col("cut")).alias("length"),
            "sequence_id",
            (F.col("at") + F.col("cut") - F.col("low")).alias("offset"),
        )
    )
    long = written(rest.where("blocks > 0").select("row", "blocks"), "long")
    long = running_total(long, [], "row", F.col("blocks"), "first")
    stretches = long.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "row", (F.col("k") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
        (F.lit(full + len(_powers(tail))) + F.col("first") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return whole.union(cuts).union(stretches)


def pack(docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """One row per piece of `docs` (doc_id, text): its place in its document and in its sequence, and its ids.

    Columns: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary, see `tokens.id_bytes`). Null and empty
    texts are the end id alone. Repeated rows are packed as often as they occur. No documents: no rows.
    """
    table = token_table(docs, path, end_id)
    width = id_width(path)
    pieces = pack_lengths(table.select("row", "doc_tokens"), capacity, grain)
    by_row = pieces.groupBy("row").agg(  # as many as the document's own length allows
        F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces")
    )
    return (
        table.join(by_row, "row")
        .select("doc_id", "doc_tokens", "ids", F.explode("pieces").alias("piece"))
        .select("doc_id", "piece.start", "piece.length", "doc_tokens", "piece.sequence_id", "piece.offset",
                F.expr(f"substring(ids, CAST(piece.start * {width} + 1 AS INT), CAST(piece.length * {width} AS INT))").alias("ids"))
    )


def ids_crc32(width: int):
    """CRC-32 of ids as unsigned little-endian 32-bit values, from the narrower form of `tokens.id_bytes`."""

    @F.pandas_udf("long")
    def crc(ids: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(np.frombuffer(x, f"<u{width}").astype("<u4").tobytes()) for x in ids], dtype="int64")

    return crc
