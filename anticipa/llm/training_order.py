"""Token sequences in training order, written as shards of records of one length."""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anticipa.llm.tokens import ROWS_AT_ONCE, id_width, worker_cache
from anticipa.session import shuffles_removed, written

SEQUENCE_TOKENS, SHARD_SLOTS = 512, 16384
ROUNDS = 6
PASSES = 2  # over the encoded table, each for its part of the shards
_HEAD = "<QqQII"  # slot, doc_id, start, tokens, 1 if doc_id is null
_END = "\r\n\r\n"


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """The slot of each index in 0..size-1, one to one: a Feistel network on 2h bits, walked until inside."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [zlib.crc32(f"{key}:{r}".encode()) for r in range(ROUNDS)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right, k) & mask)
        return left << np.uint64(half) | right

    out = once(index.astype(np.uint64))
    while len(outside := np.flatnonzero(out >= size)):
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def places(first: Column, count: Column, size: int, key: int, slots: range) -> Column:
    """Array column: k and slot of each sequence first + k, k in 0..count-1, whose slot is in `slots`."""

    @F.arrow_udf("array<struct<k: long, slot: long>>")
    def of(first: pa.Array, count: pa.Array) -> pa.Array:
        worker_cache.cache_clear()  # of a stage before this one in the same worker: sorting needs the room
        n = count.to_numpy()
        ends = np.cumsum(n)
        k = np.arange(n.sum()) - np.repeat(ends - n, n)
        slot = permuted(np.repeat(first.to_numpy(), n) + k, size, key)
        here = (slot >= slots.start) & (slot < slots.stop)
        offsets = np.append(0, np.cumsum(here))[np.append(0, ends)]
        found = pa.StructArray.from_arrays([pa.array(k[here]), pa.array(slot[here])], ["k", "slot"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found)

    return of.asNondeterministic()(first, count)  # only so that no filter made of it has them computed twice


def record_bytes(width: int, tokens: int = SEQUENCE_TOKENS) -> int:
    return struct.calcsize(_HEAD) + width * tokens + len(_END)


def _numbered(docs: DataFrame, path: str, end_id: int, tokens: int) -> DataFrame:
    """(part, before, doc_id, doc_tokens, ids), written: `before` sequences of the same part come before this row's."""

    names = ["part", "before", "doc_id", "doc_tokens", "ids"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, before = worker_cache(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], words.dtype).tobytes()
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(a, ROWS_AT_ONCE)
                ids = words.encode_array(some["text"], end)
                n = pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // words.dtype.itemsize
                ends = before + np.cumsum(-(-n // tokens))
                starts = np.append(before, ends[:-1])
                columns = [np.full(len(n), part, np.int64), starts, some["doc_id"], n, ids]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)
                before = int(ends[-1])

    given = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    rows = given.mapInArrow(encode, "part long, before long, doc_id string, doc_tokens long, ids binary")
    return written(rows, "tokens", compression="zstd")


def write_in_order(
    docs: DataFrame, folder: str, path: str, key: int, end_id: int = 2,
    tokens: int = SEQUENCE_TOKENS, shard_slots: int = SHARD_SLOTS, passes: int = PASSES,
) -> int:
    """Write every sequence of `docs` (doc_id, text) to its slot under `folder`; the number of sequences.

    A document's ids (null and empty texts: the end id alone) are cut into sequences of `tokens`, the last one filled
    with zeros. Sequences are numbered, and a keyed permutation of 0..n-1 gives each its slot. Shard k, the one file in
    `shard=k`, holds slots k * shard_slots onwards in order, each in `record_bytes`: head, ids, end mark. Spark's own
    writer commits the files, so a lost task is written anew. The shards are written in `passes` runs of them, one after
    the other, so that the shuffle of only one run is on disk at a time; `_SUCCESS` comes with the last. Repeated rows are
    sequences of their own. No documents: no shard.
    """
    width = id_width(path)
    table = _numbered(docs, path, end_id, tokens)
    parts = table.groupBy("part").agg(F.max(F.col("before") + F.ceil(F.col("doc_tokens") / tokens)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task that wrote the table
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"), "n")
    size = parts.agg(F.max(F.col("base") + F.col("n"))).first()[0] or 0
    placed = table.join(F.broadcast(parts), "part")  # a row per task that wrote the table

    def record(slots: pd.Series, ids: pd.Series, starts: pd.Series, n: pd.Series, tokens_of: pd.Series) -> pd.Series:
        known = ids.notna()
        return pd.Series(
            [
                struct.pack(_HEAD, s, int(i) if k else 0, a, m, not k) + t.ljust(width * tokens, b"\0")
                for s, i, k, a, m, t in zip(slots, ids, known, starts, n, tokens_of)
            ],
            dtype=object,
        )

    packed = F.pandas_udf(record, "binary")("slot", "doc_id", "start", "n", "ids")
    shards = max(1, -(-size // shard_slots))
    each = -(-shards // passes)
    with shuffles_removed(docs.sparkSession):
        for first in range(0, shards, each):
            n = min(each, shards - first)
            slots = range(first * shard_slots, (first + n) * shard_slots)
            here = places(F.col("base") + F.col("before"), F.ceil(F.col("doc_tokens") / tokens), max(1, size), key, slots)
            (
                placed.withColumn("place", F.explode(here))  # of whole documents: their ids are not repeated before they are cut
                .select(
                    "place.slot", "doc_id", (F.col("place.k") * tokens).alias("start"),
                    F.least(F.lit(tokens).cast("long"), F.expr(f"doc_tokens - place.k * {tokens}")).alias("n"),
                    F.expr(f"substring(ids, CAST(place.k * {tokens * width} + 1 AS INT), {tokens * width})").alias("ids"),
                    F.expr(f"place.slot DIV {shard_slots}").alias("shard"),
                )
                .repartitionById(n, (F.col("shard") - first).cast("int"))  # ranges of slots: one task and one file a shard
                .sortWithinPartitions("slot")
                .select("shard", packed.cast("string").alias("value"))
                .write.mode("append" if first else "error").partitionBy("shard")
                .option("lineSep", _END)
                .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", first + n == shards)
                .text(folder)
            )
    return size


def read_in_order(
    spark: SparkSession, folder: str, width: int, tokens: int = SEQUENCE_TOKENS, shards: str = "*", crc: bool = False
) -> DataFrame:
    """The records of the shards: slot, doc_id, start, tokens, ids. `shards` picks some, for going on where one left.

    With `crc` there is, instead of the ids, the CRC-32 of them as unsigned little-endian 32-bit values.
    """
    stride = record_bytes(width, tokens)

    def rows(records: Iterator[bytes]):
        head = struct.calcsize(_HEAD)
        for r in records:
            s, i, a, n, null = struct.unpack_from(_HEAD, r)
            ids = r[head : head + n * width]
            out = zlib.crc32(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()) if crc else bytearray(ids)
            yield s, None if null else i, a, n, out

    records = spark.sparkContext.binaryRecords(f"{folder}/shard={shards}", stride).mapPartitions(rows)
    last = "ids_crc32 long" if crc else "ids binary"
    return spark.createDataFrame(records, f"slot long, doc_id long, start long, tokens long, {last}")
