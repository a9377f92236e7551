"""Shards of near-equal bytes as the leaves of a k-d tree over document metadata."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from anticipa.llm.common import running_total
from anticipa.session import written

CELLS = 2048
ROW_OVERHEAD = 16
DIMENSIONS = ("size", "lang_code", "source_code")
_TIES = ("text_crc32", "tie")  # equal texts stay side by side; rows of one group are told apart by a hash of doc_id


@dataclass
class _Cut:
    """Search for the place in a node's order where its left part reaches `goal` bytes."""

    node: int
    left_leaves: int
    leaves: int
    goal: float
    keys: tuple[str, ...]
    fixed: list[int] = field(default_factory=list)
    low: int = 0
    high: int = 0  # of the current key: low <= value < high
    before: int = 0
    step: int = 1
    last: Row | None = None  # the cell that the last pass ended in

    @property
    def key(self) -> str:
        return self.keys[len(self.fixed)]


def metadata(docs: DataFrame) -> DataFrame:
    """(row, doc_id, size, text_crc32, lang_code, source_code, tie) of every document; all but doc_id are longs.

    size is the UTF-8 bytes of the text plus 16; a null text has none and the CRC of an empty one. Codes of null labels
    are those of an empty one.
    """
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")

    def code(name: str):
        return F.crc32(F.encode(F.coalesce(F.col(name).cast("string"), F.lit("")), "UTF-8"))

    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        code("lang").alias("lang_code"),
        code("source").alias("source_code"),
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)).alias("tie"),
    )


def _refine(rows: DataFrame, cuts: list[_Cut]) -> None:
    """One pass over the rows: narrow every cut to the cell of its current key that holds the goal."""
    value = F.lit(None).cast("long")
    for cut in cuts:  # fewer than there are shards
        here = F.col("node") == cut.node
        for name, v in zip(cut.keys, cut.fixed):
            here &= F.col(name) == v
        here &= (F.col(cut.key) >= cut.low) & (F.col(cut.key) < cut.high)
        cut.step = -(-(cut.high - cut.low) // CELLS)
        cell = F.expr(f"(`{cut.key}` - {cut.low}) DIV {cut.step}")
        value = F.when(here, cell).otherwise(value)
    cells = (
        rows.select("node", "size", value.alias("cell")).where("cell IS NOT NULL")
        .groupBy("node", "cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        .collect()
    )
    by_node: dict[int, list] = {}
    for r in sorted(cells, key=lambda r: r["cell"]):
        by_node.setdefault(r["node"], []).append(r)
    for cut in cuts:
        chosen = None
        for r in by_node.get(cut.node, []):
            if chosen is not None:
                cut.before += chosen["bytes"]
            chosen = r
            if cut.before + r["bytes"] >= cut.goal:
                break
        cut.low, cut.high = cut.low + chosen["cell"] * cut.step, min(cut.high, cut.low + (chosen["cell"] + 1) * cut.step)
        cut.last = chosen


def _settled(cut: _Cut) -> bool:
    """Move on to the next key where one value is left; true if the cut is found."""
    while cut.high - cut.low == 1:
        cut.fixed.append(cut.low)
        if cut.last["n"] == 1 or len(cut.fixed) == len(cut.keys):
            # The row that holds the goal goes to the side that it brings nearer to it.
            after = cut.before + cut.last["bytes"]
            if after - cut.goal > cut.goal - cut.before:
                cut.fixed[-1] -= 1
            return True
        cut.low, cut.high = (0, 1 << 32) if cut.key in _TIES else (-(1 << 62), 1 << 62)
    return False


def kd_leaves(rows: DataFrame, leaves: int, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """`rows` with `node`, the number of their leaf: 0 to leaves - 1, of near-equal sums of `size`.

    A node that needs several leaves is cut along the dimension (a long column) that is widest in it, measured against
    the whole table, where its left part has its share of the bytes. The weighted median is found by passes that
    sum bytes over `CELLS` cells of the open interval of every node of a level at once, so only cells come to the
    driver and a value that holds a third of all rows is one cell; rows of one value are cut by the tie keys. Rows
    that agree in all keys stay together.
    """
    finished = 0
    rows = rows.withColumn("node", F.lit(0))
    span = rows.agg(*(f(F.col(d)).alias(f"{n}_{d}") for d in dimensions for n, f in (("lo", F.min), ("hi", F.max)))).first()
    open_nodes, numbers = {0: (0, leaves)}, 1  # node: its first leaf and how many it needs
    done: dict[int, int] = {} if leaves > 1 else {0: 0}
    while open_nodes and leaves > 1:
        stats = (
            rows.groupBy("node")
            .agg(F.sum("size").alias("bytes"), *(f(F.col(d)).alias(f"{n}_{d}") for d in dimensions for n, f in (("lo", F.min), ("hi", F.max))))
            .collect()
        )
        cuts = []
        for s in stats:
            if s["node"] not in open_nodes:
                continue
            count = open_nodes[s["node"]][1]

            def width(d: str) -> float:
                return (s[f"hi_{d}"] - s[f"lo_{d}"]) / max(1, span[f"hi_{d}"] - span[f"lo_{d}"])

            widest = max(dimensions, key=width)
            left = count // 2
            others = tuple(d for d in dimensions if d != widest)
            cuts.append(_Cut(s["node"], left, count, s["bytes"] * left / count, (widest, *_TIES, *others),
                             low=s[f"lo_{widest}"], high=s[f"hi_{widest}"] + 1))
        pending = list(cuts)
        while pending:
            _refine(rows, pending)
            pending = [c for c in pending if not _settled(c)]
        number = F.col("node")
        following: dict[int, tuple[int, int]] = {}
        for cut in cuts:
            first, _ = open_nodes[cut.node]
            # Left: the keys, compared in order, are at most the cut's.
            right = F.lit(False)
            for name, v in reversed(list(zip(cut.keys, cut.fixed))):
                right = (F.col(name) > v) | ((F.col(name) == v) & right)
            number = F.when(F.col("node") == cut.node, F.when(right, numbers + 1).otherwise(numbers)).otherwise(number)
            for child, (at, n) in ((numbers, (first, cut.left_leaves)), (numbers + 1, (first + cut.left_leaves, cut.leaves - cut.left_leaves))):
                if n > 1:
                    following[child] = (at, n)
                else:
                    done[child] = at
            numbers += 2
        for node in open_nodes.keys() - {c.node for c in cuts}:  # without rows
            done[node] = open_nodes[node][0]
        rows = written(rows.withColumn("node", number), f"level-{finished}")
        open_nodes, finished = following, finished + 1
    numbered = [F.lit(x) for pair in done.items() for x in pair]  # as many as there are shards
    return rows.withColumn("node", F.create_map(*numbered)[F.col("node")])


def shard_by_bytes(docs: DataFrame, shards: int) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot. Shards are leaves of near-equal bytes.

    `slot` numbers a shard's rows without gaps. Copies of a text lie side by side in every cut and part only where a
    cut falls among them. Repeated rows are rows of their own. With fewer rows than shards some shards stay empty; no
    documents: no rows.
    """
    rows = written(metadata(docs), "metadata")
    if rows.isEmpty():
        shard = F.lit(0).alias("shard")
        return rows.select("doc_id", "size", "text_crc32", shard, F.lit(0).cast("long").alias("slot"))
    leaves = written(kd_leaves(rows, shards), "leaves")
    return running_total(leaves, ["node"], "row", F.lit(1), "slot").select(
        "doc_id", "size", "text_crc32", F.col("node").alias("shard"), "slot"
    )
