"""Licence notices in texts through a positional index of rare tokens of the templates."""

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anticipa.llm.common import ascii_lower

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Base phrases and their labels. Fixed values of the contract.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: label: template text, and the phrase that has to stand in the file for the label to hold.
TEMPLATES = {
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", "permission is hereby granted free of charge"),
    "apache-2": ("licensed under the apache license version 2 0", "apache license version 2"),
    "gpl-3": ("this work is licensed under the gnu general public license version 3", "general public license version 3"),
    "gpl-2": ("this work is licensed under the gnu general public license version 2", "general public license version 2"),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",
            "redistribution and use in source and binary forms"),
    "cc-by-nc": ("licensed under cc by nc 4 0", "cc by nc"),
    "cc-by-sa": ("licensed under cc by sa 4 0", "cc by sa"),
}
#: How many rare words of a template are posted, and how many of them have to agree on where it begins.
RARE_WORDS, AGREEING = 3, 2


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null texts and texts without words have none."""
    split = F.split(ascii_lower(F.coalesce(text, F.lit(""))), _NOT_WORD, -1)
    return F.filter(split, lambda w: w != "")


def document_frequencies(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many rows of `words` each word of `vocabulary` occurs: a row per word, summed where the texts are."""
    listed = F.array(*(F.lit(w) for w in vocabulary))
    held = words.select(F.explode(F.array_intersect("words", listed)).alias("word"))
    return dict(held.groupBy("word").count().collect())


def _at(words: Column, start: Column, phrase: list[str]) -> Column:
    """Whether `phrase` stands in `words` at `start` (from 0)."""
    out = (start >= 0) & (start + len(phrase) <= F.size(words))
    for k, w in enumerate(phrase):
        out &= F.get(words, start + k) == w
    return out


def _starts_by(places: Column, word: str, k: int) -> Column:
    """Where a text begins whose word number `k` is posted."""
    return F.transform(F.filter(places, lambda p: p.w == word), lambda p: p.i - k)


def _posted(places: Column, words: Column, phrase: list[str], rare: int) -> Column:
    """Starts of `phrase`: the postings of its rarest word, moved to the phrase's start and verified."""
    return F.filter(_starts_by(places, phrase[rare], rare), lambda s: _at(words, s, phrase))


def _share(words: Column, start: Column, template: list[str]) -> Column:
    """The share of the template's words that stand at their relative positions."""
    hits = F.lit(0)
    for k, w in enumerate(template):
        hits += F.coalesce(F.get(words, start + k) == w, F.lit(False)).cast("int")
    return hits / F.lit(float(len(template)))


def _offset(template: list[str], phrase: list[str]) -> int:
    return next(k for k in range(len(template)) if template[k : k + len(phrase)] == phrase)


def _agreed(places: Column, template: list[str], rare: list[int], needed: int) -> Column:
    """Where a text begins by the postings of `needed` of the words numbered `rare`, intersected by relative position."""
    starts = [_starts_by(places, template[k], k) for k in rare]
    return reduce(F.array_union, (reduce(F.array_intersect, some) for some in combinations(starts, needed)))


def _laid_share(places: Column, words: Column, template: list[str], mandatory: list[str], rare: list[int], needed: int) -> Column:
    """Best share of the template, laid where enough of its rare words agree and its mandatory phrase stands; null if nowhere."""
    if len(rare) < needed:
        return F.lit(None).cast("double")
    offset = _offset(template, mandatory)
    laid = F.filter(_agreed(places, template, rare, needed), lambda s: _at(words, s + offset, mandatory))
    return F.array_max(F.transform(laid, lambda s: _share(words, s, template)))


def anchors_of(template: list[str], mandatory: list[str], seen: dict[str, int]) -> tuple[list[int], int]:
    """The places in `template` of its rare words, and how many of them have to agree.

    They are the `RARE_WORDS` rarest that occur, outside the mandatory phrase, so that the phrase, which is verified
    anyhow, can't agree with itself. `AGREEING` have to, or all words outside the phrase if the template has fewer. A template
    that is its phrase alone is found by the phrase's rarest word.
    """
    offset = _offset(template, mandatory)
    own = range(offset, offset + len(mandatory))

    def rarity(k: int) -> tuple:
        return seen.get(template[k], 0), template[k], k

    others = [k for k in range(len(template)) if k not in own]
    if not others:
        return [min(own, key=rarity)], 1
    return sorted((k for k in others if seen.get(template[k])), key=rarity)[:RARE_WORDS], min(AGREEING, len(others))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row per document of `docs` (doc_id, text): doc_id, n_words, starts, base_labels, labels, score.

    The words of all phrases and templates are weighed by how many documents hold them. A file's postings (word, place)
    are kept for the rarest words only: the rarest of each phrase, and those of `anchors_of` each template. A phrase's
    starts are its rarest word's places, verified word by word. A template is laid where the postings of enough of its
    rare words agree on a relative position; the label holds if its mandatory phrase stands there. score is the best
    share of a template's words found at their places, for a label that holds; 1 for base phrases, 0 without
    labels. Null and empty texts have no words. Repeated rows are scanned alike; no documents: no rows.
    """
    named = {label: (t.split(), m.split()) for label, (t, m) in templates.items()}
    wanted = [(p.split(), label) for p, label in phrases]
    vocabulary = sorted({w for p, _ in wanted for w in p} | {w for t, _ in named.values() for w in t})
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    seen = document_frequencies(words, vocabulary)

    def rarity(word: str) -> tuple:
        return seen.get(word, 0), word

    rare_of = [min(range(len(p)), key=lambda k: rarity(p[k])) for p, _ in wanted]
    anchors = {label: anchors_of(t, m, seen) for label, (t, m) in named.items()}
    posted = sorted({p[r] for (p, _), r in zip(wanted, rare_of)} | {named[l][0][k] for l, (a, _) in anchors.items() for k in a})
    numbered = F.zip_with("words", F.sequence(F.lit(0), F.size("words")), lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    places = F.when(
        F.arrays_overlap("words", F.array(*(F.lit(w) for w in posted))),
        F.filter(numbered, lambda p: p.w.isin(posted)),
    ).otherwise(F.array().cast("array<struct<w:string,i:int>>"))
    posted_rows = words.select("doc_id", "words", places.alias("places"))

    starts = [_posted(F.col("places"), F.col("words"), p, r) for (p, _), r in zip(wanted, rare_of)]
    held = [
        F.struct(
            F.lit(label).alias("label"),
            _laid_share(F.col("places"), F.col("words"), template, mandatory, *anchors[label]).alias("share"),
        )
        for label, (template, mandatory) in named.items()
    ]
    found = posted_rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.array(*(F.struct(F.lit(label).alias("label"), s.alias("at")) for (_, label), s in zip(wanted, starts))).alias("base"),
        F.filter(F.array(*held), lambda h: h.share.isNotNull()).alias("held"),
    )
    base_labels = F.array_sort(F.array_distinct(F.transform(F.filter("base", lambda b: F.size(b.at) > 0), lambda b: b.label)))
    both = F.array_sort(F.array_union(base_labels, F.transform("held", lambda h: h.label)))
    return found.select(
        "doc_id", "n_words",
        F.array_sort(F.flatten(F.transform("base", lambda b: b.at))).alias("starts"),
        base_labels.alias("base_labels"),
        both.alias("labels"),
        F.when(F.size(base_labels) > 0, F.lit(1.0))
        .otherwise(F.coalesce(F.array_max(F.transform("held", lambda h: h.share)), F.lit(0.0))).alias("score"),
    )
