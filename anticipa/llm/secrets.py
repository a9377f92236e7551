"""Secrets in texts, found by regular expressions behind a trigram inverted index."""

import re
from collections.abc import Callable
from re import _constants as ops
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anticipa.llm.common import columns_of
from anticipa.session import written

#: kind: pattern, the group whose length counts, its least length. Order is the order of kinds at one place.
RULES = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
    "private_key": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
}
BASE = ("assign", "access", "hex")
# Column names of our own, which no table of a user has.
_ID, _KINDS = "anticipa candidate id", "anticipa candidate kinds"
SPANS = "array<struct<start:int,kind_rank:int,end:int,kind:string>>"


def _literals(tree) -> list[list[str]]:
    """What every match of the parsed pattern holds: alternatives, each strings in order, with anything between two of them.

    An alternative of one string is closed: the match is that text. Others are open: the first string begins the match,
    the last ends it, and only these join what stands beside them.
    """
    alternatives = [[""]]
    for op, arg in tree:
        if op is ops.LITERAL and arg < 128:
            parts = [[chr(arg).lower()]]
        elif op is ops.SUBPATTERN:
            parts = _literals(arg[-1])
        elif op is ops.BRANCH:
            parts = [x for branch in arg[1] for x in _literals(branch)]
        elif op is ops.MAX_REPEAT and arg[:2] == (0, 1) and len(arg[2]) == 1 and arg[2][0][0] is ops.LITERAL and arg[2][0][1] < 128:
            parts = [[""], [chr(arg[2][0][1]).lower()]]  # an optional character
        else:
            parts = [["", ""]]  # anything may stand here (other letters change with their neighbours in lower case)
        alternatives = [a[:-1] + [a[-1] + p[0]] + p[1:] for a in alternatives for p in parts]
    return alternatives


def trigram_query(pattern: str) -> list[set[str]] | None:
    """Alternatives of trigrams of the text in lower case, one of which has to hold as a whole; None: no such query."""
    alternatives = [
        {s[k : k + 3] for s in strings for k in range(len(s) - 2)} for strings in _literals(parser.parse(pattern))
    ]
    return alternatives if all(alternatives) else None


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, also where it is needed within lambdas."""
    return F.transform(F.array(value), use)[0]


def before_each(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For every number of an array what `combine` makes of those before it, 0 at first.

    Arrays grow by copying, so the array is taken in blocks of its size's root: n values cost n to the power of 1.5.
    """

    def within(block: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), F.array().cast("array<int>").alias("seen"))
        step = lambda s, x: F.struct(combine(s.at, x).alias("at"), F.concat(s.seen, F.array(s.at)).alias("seen"))
        return F.aggregate(block, state, step).seen

    def of_blocks(blocks: Column) -> Column:
        starts = within(F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), combine)), F.lit(0))
        return F.flatten(F.zip_with(blocks, starts, within))

    def of_values(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        last = F.floor((F.size(v) - 1) / width).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(v, k * width + 1, width))
        return F.when(F.size(v) > 0, _bound(blocks, of_blocks)).otherwise(F.array().cast("array<int>"))

    return _bound(values, of_values)


def _spans(text: Column, kind: str, rules: dict) -> Column:
    """Every match of a rule as a span in code points. Matches and what lies between them give the places."""
    pattern, group, least = rules[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.struct(F.length(b).alias("b"), F.length(m).alias("m"))),
        F.transform(counted, F.length),
        lambda p, n: F.struct(p.b.alias("b"), p.m.alias("m"), n.alias("n")),
    )

    def placed(p: Column, at: Column) -> Column:
        start = at + p.b
        return F.struct(
            start.alias("start"), F.lit(list(rules).index(kind)).alias("kind_rank"), (start + p.m).alias("end"),
            F.lit(kind).alias("kind"), p.n.alias("n"),
        )

    def of_steps(s: Column) -> Column:
        ends = before_each(F.transform(s, lambda p: p.b + p.m), lambda x, y: x + y)
        return F.filter(F.zip_with(s, ends, placed), lambda p: p.n >= least)

    plain = lambda p: F.struct(*(p[c].alias(c) for c in ("start", "kind_rank", "end", "kind")))
    return F.transform(_bound(steps, of_steps), plain)


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, doc_id), written, sorted by trigram within files: which documents hold which of `trigrams`.

    A search of a text's bytes per trigram costs a third of one pass with a pattern of them all, and keeps no places.
    """
    lowered = docs.where("text IS NOT NULL").select("doc_id", F.lower("text").alias("lowered"))  # once a text
    held = F.array_compact(F.array(*(F.when(F.contains("lowered", F.lit(t)), F.lit(t)) for t in trigrams)))
    # A plain explode would have the optimizer ask first whether there is anything in it, which finds it all again.
    postings = lowered.select("doc_id", held.alias("held")).select(F.explode_outer("held").alias("trigram"), "doc_id")
    postings = postings.where("trigram IS NOT NULL")
    return written(postings.sortWithinPartitions("trigram"), "trigrams")


def candidates(index: DataFrame, queries: dict[str, list[set[str]]]) -> DataFrame:
    """(doc_id, kinds): documents for which a rule's trigram query holds.

    Each alternative of a query is an intersection of postings: the documents that stand in the lists of all its trigrams.
    The queries are a small table of fixed size; counts are combined before they are shuffled.
    """
    asked = [
        F.struct(F.lit(kind).alias("kind"), F.lit(k).alias("alternative"), F.lit(t).alias("wanted"), F.lit(len(needed)).alias("needed"))
        for kind, query in queries.items() for k, needed in enumerate(query) for t in sorted(needed)
    ]
    wanted = index.sparkSession.range(1).select(F.inline(F.array(*asked)))
    found = index.dropDuplicates(["trigram", "doc_id"]).join(F.broadcast(wanted), F.col("trigram") == F.col("wanted"))
    whole = found.groupBy("doc_id", "kind", "alternative").agg(F.count("*").alias("lists"), F.first("needed").alias("needed"))
    return whole.where("lists = needed").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))  # no more than rules


def with_spans(docs: DataFrame, rules: dict | None = None, name: str = "spans") -> DataFrame:
    """`docs` (doc_id, text and any others) with the column `name`: the secrets in its text, sorted by start and order of kinds.

    Rules with a trigram query are tried only on documents that the index says may match, the others on every text.
    Null and empty texts have no spans. Repeated rows and doc_ids that stand for several texts each get the spans of
    their own text; a null doc_id is an id like any other. No documents: no rows.
    """
    rules = RULES if rules is None else rules
    queries = {k: q for k, (p, _, _) in rules.items() if (q := trigram_query(p))}
    text = F.coalesce(F.col("text"), F.lit(""))
    marked, listed = docs, F.array().cast("array<string>")
    if queries:
        index = trigram_index(docs, sorted({t for q in queries.values() for needed in q for t in needed}))
        hits = written(candidates(index, queries), "candidates").select(
            F.col("doc_id").alias(_ID), F.col("kinds").alias(_KINDS)
        )
        marked = docs.join(hits, F.col("doc_id").eqNullSafe(F.col(_ID)), "left")
        listed = F.coalesce(_KINDS, listed)
    none = F.array().cast(SPANS)
    found = [
        F.when(F.array_contains(listed, k), _spans(text, k, rules)).otherwise(none) if k in queries else _spans(text, k, rules)
        for k in rules
    ]
    return marked.select(*columns_of(docs), F.sort_array(F.concat(*found)).alias(name))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """`text` with every span, and spans that overlap as one, replaced by `mark`."""

    def of_spans(found: Column) -> Column:
        ends = F.transform(found, lambda s: s.end)
        covered = before_each(ends, lambda x, y: F.greatest(x, y))

        def of_letters(letters: Column) -> Column:
            def piece(s: Column, end: Column) -> Column:
                before = F.concat(F.slice(letters, end + 1, F.greatest(s.start - end, F.lit(0))), F.array(F.lit(mark)))
                return F.when(s.start >= end, before).otherwise(F.array().cast("array<string>"))

            tail = F.slice(letters, F.array_max(ends) + 1, F.size(letters))
            return F.array_join(F.concat(F.flatten(F.zip_with(found, covered, piece)), tail), "")

        return _bound(F.split(text, ""), of_letters)

    return F.when(F.size(spans) > 0, _bound(spans, of_spans)).otherwise(text)
