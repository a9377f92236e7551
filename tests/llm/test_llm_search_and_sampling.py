"""Ranked search, importance resampling and MinHash: brute force, edge cases and tiles."""

import re
import zlib
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from anticipa.llm import byte_words, importance, lexical_search, minhash

SCHEMA = "doc_id long, text string, rank string, score string, n string, `key` string, node string, `a b` int"
WORDS = [f"w{i}" for i in range(60)]


def table(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", "y", "z", "k", "v", 1) for i, t in rows], SCHEMA)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def random_docs(seed, n):
    rng = np.random.default_rng(seed)
    texts = [" ".join(rng.choice(WORDS, rng.integers(0, 80) ** 2 // 60)) for _ in range(n)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(i + n, re.sub(r"\bw1\b", "W1!", t)) for i, t in rows[::3]]  # copies to the terms, in other letters
    return rows + [(rows[0][0], rows[0][1]), (None, texts[1]), (900, None), (901, ""), (902, "?! "), (903, "É é ñandú W5 " * 30), (904, "w3 " * 70_000)]


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(byte_words, "PIECE_BYTES", 50)
    text = ("a b-c ÀÉ\t" + "x" * 120 + "\n D ") * 20
    whole = text.encode()
    assert [w.decode() for p in byte_words.terms(whole) for w in p] == terms(text)
    assert [w for p in byte_words.words(whole) for w in p] == whole.lower().split()
    for size in (50, 1 << 22):
        monkeypatch.setattr(byte_words, "PIECE_BYTES", size)
        assert minhash.shingle_set(whole).tolist() == sorted(set(minhash.shingle_set(whole).tolist()))
        grams = [g for part in importance._grams([whole, None, whole], 3) for g in part[0]]
        words = terms(text)
        want = Counter(" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))
        assert Counter(g.decode() for g in grams) == want + want
    a = minhash.shingle_set(whole)
    monkeypatch.setattr(byte_words, "PIECE_BYTES", 50)
    assert a.tolist() == minhash.shingle_set(whole).tolist()


def search_plainly(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    for item, words in wanted.items():
        scores = []
        for doc, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * n // length
            s = sum(floor(1000 * log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in words if w in c)
            scores.append((-s, doc is None, doc or 0, doc))
        for rank, (s, _, _, doc) in enumerate(sorted(x for x in scores if x[0] < 0)[:k], 1):
            yield item, rank, doc, -s


@pytest.mark.parametrize("block_terms", [1 << 17, 5])
def test_search_equals_brute_force(spark, monkeypatch, block_terms):
    for name, value in (("ITEM_TILE", 2), ("DOCUMENT_TILE", 16), ("VOCABULARY_TILE", 3)):
        monkeypatch.setattr(lexical_search, name, value)
    docs = random_docs(1, 60)
    items = [(1, "w1 w2 W3 w3"), (2, " ".join(WORDS)), (3, None), (4, "..."), (None, "w7 ñandú"), (5, "w9"), (5, "w9 w11"), (6, "absent")]
    found = lexical_search.search(table(spark, docs).repartition(3), table(spark, items).withColumnRenamed("doc_id", "item_id"), 4, block_terms)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, search_plainly(docs, items, 4)))


def test_best_keeps_ties_by_id():
    best = lexical_search._Best(2, 3)
    for start in (50, 10, 30):
        docs = np.arange(start, start + 10)
        best.add(np.array([np.full(10, 7), np.where(docs % 10 < 2, docs % 10 + 1, 0)]), docs, docs == 11)
    assert best.doc[best.item == 0].tolist() == [10, 12, 13] and best.doc[best.item == 1].tolist() == [31, 51, 11]


def test_interning_verifies_bytes():
    grams = [b"a", b"b", b"a", b"c", b"b", b"a"] * 50
    for digest in (lambda g: 5, lambda g: ord(g) % 2):  # all keys collide, or some
        found = importance.Interned(grams, 97, digest)
        assert found.bucket[found.slot].tolist() == [zlib.crc32(g) % 97 for g in grams]
        assert [found.count[s] for s in found.slot[:4]] == [150, 100, 150, 50] and len(found.used) == 3


@pytest.mark.parametrize("run_words", [1, 2])
def test_resample_equals_brute_force(spark, monkeypatch, run_words):
    monkeypatch.setattr(importance, "_GRAMS_AT_ONCE", 100)
    docs, target = random_docs(2, 80), [(1, "w1 w2 w3 w4 " * 5), (2, None)]

    def features(text):
        w = terms(text)
        return [" ".join(w[i : i + n]) for n in range(1, run_words + 1) for i in range(len(w) - n + 1)]

    import hashlib

    counts = [Counter(zlib.crc32(f.encode()) % 100 for _, t in rows for f in features(t)) for rows in (docs, target)]
    s_all, t_all = (sum(c.values()) for c in counts)
    gain = [floor(1000 * log((counts[1][b] + 1) * (s_all + 100) / ((counts[0][b] + 1) * (t_all + 100)))) for b in range(100)]
    want = []
    for doc, text in docs:
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        f = features(text)
        weight = sum(gain[zlib.crc32(x.encode()) % 100] for x in f)
        want.append((doc, len(terms(text)), len(f), weight, weight + floor(-1000 * log(-log((h + 0.5) / 4294967296)))))
    able = sorted((-r[4], r[0] is None, r[0] or 0, i) for i, r in enumerate(want) if r[1] >= 20)
    drawn = {x[3]: n for n, x in enumerate(able[: 30 * len(able) // 100], 1)}
    got = importance.resample(table(spark, docs).repartition(3), table(spark, target), run_words, 100, 20, 30, 7)
    assert len(drawn) > 5
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((*r, drawn.get(i))) for i, r in enumerate(want))


def test_ranks_over_many_ranges_with_repeated_rows(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), (F.col("id") % 3 % 2).alias("score")
    )
    got = importance.ranked(rows, 3001, 5000, rows_per_range=100).join(rows, "row").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 3002))
    order = [(-r["score"], r["doc_id"]) for r in got]
    assert order == sorted(order) and got[1668]["doc_id"] == 5 and got[1669]["doc_id"] == got[3000]["doc_id"] == 7


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def near_docs(seed):
    """Chains of texts that differ in a few words, a template that many texts share, copies in other letters, and short texts."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(6):
        words = [f"v{x}" for x in rng.integers(0, 10_000, 120)]
        for _ in range(12):
            rows.append(" ".join(words))
            words[rng.integers(0, 120)] = f"n{rng.integers(0, 10_000)}"
    template = [f"t{x}" for x in range(100)]
    for _ in range(40):  # about 0.8 alike, so some are linked and some not
        words = list(template)
        for at in rng.choice(100, 4, replace=False):
            words[at] = f"n{rng.integers(0, 10_000)}"
        rows.append(" ".join(words))
    rows += [rows[3].upper(), rows[5] + "\n", rows[7], "a b", "A  b", "a", "a b c", None, "", " \t", "z " * 50, "z z z"]
    return [(i * 3 % 1000, t) for i, t in enumerate(rows)]


def groups(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    label = list(range(len(sets)))
    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 85 * len(x | y) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if v == old else v for v in label]
    for i, (doc, s) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(sets)) if label[j] == label[i] and sets[j][0] is not None]
        yield doc, len(s), min(ids) if s and ids else doc


@pytest.mark.parametrize("seed, tile_rows", [(1, 1024), (2, 7)])
def test_minhash_groups_equal_brute_force(spark, seed, tile_rows):
    docs = near_docs(seed) + [(None, "no id here at all"), (None, None), (3, "a b")]
    got = minhash.near_duplicates(table(spark, docs).repartition(3), tile_rows=tile_rows).collect()
    assert sorted(repr(tuple(r)[:3]) for r in got) == sorted(map(repr, groups(docs)))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    for share in (0.2, 0.5, 0.9):
        n = int(1000 * share)
        sets = [np.sort(pool[:1000]), np.sort(np.append(pool[:n], pool[1000 : 2000 - n]))]
        x, y = minhash.signatures(sets, 1920)
        assert abs((x == y).mean() - n / (2000 - n)) < 0.05


def test_posterior_bounds():
    assert minhash.least_matches(16, 0.85, 1e-9) < 16 * 0.85 and minhash.least_matches(130, 0.85, 1e-9) > 130 * 0.55
    assert minhash.least_matches(0, 0.85, 1e-9) == 0
    rng = np.random.default_rng(4)
    agree = rng.random((20_000, 130)) < 0.85  # pairs just at the threshold are not lost
    x = rng.integers(0, 1 << 15, (20_000, 130)).astype(np.uint16)
    assert len(minhash.passing(x, np.where(agree, x, x + 1).astype(np.uint16))) == 20_000
    low = np.where(rng.random((20_000, 130)) < 0.3, x, x + 1).astype(np.uint16)
    assert len(minhash.passing(x, low)) == 0


def test_empty_tables(spark):
    none, some = table(spark, []), table(spark, [(1, "w1 w2 w3")])
    assert minhash.near_duplicates(none).count() == 0
    for docs, items in ((none, some), (some, none), (none, none)):
        assert lexical_search.search(docs, items.withColumnRenamed("doc_id", "item_id")).collect() == []
    assert importance.resample(none, some).count() == 0
    assert [tuple(r)[:4] for r in importance.resample(some, none).collect()] == [(1, 3, 3, 3 * importance.bucket_gains(
        importance.bucket_counts(some), importance.bucket_counts(none))[zlib.crc32(b"w1") % 10_000])]
