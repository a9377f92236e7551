"""SQL for the queries that SQL can express, run by DuckDB over the same tables."""

from anticipa.llm import licenses, secrets
from anticipa.llm.common import LOWER, UPPER
from anticipa.llm.url_reputation import BAD_LIMIT, LEAST_STRENGTH, MOST_STRENGTH, RULES, SIGMAS

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(map(_text, words)) + "]"


def _sums(children: str, group: str, name: str) -> str:
    by = f"GROUP BY {group}" if group else ""
    keys = f"{group}, " if group else ""
    return f"""{name} AS (SELECT {keys}count(*) k, sum(pages)::DOUBLE pages, sum(bad)::DOUBLE bad, sum(pages * pages)::DOUBLE nn,
  sum(bad * (bad / pages::DOUBLE)) br FROM {children} {by})"""


def _strength(groups: str, name: str) -> str:
    return f"""{name} AS (SELECT least(greatest(CASE WHEN coalesce(inner_var, 0) = 0 THEN {LEAST_STRENGTH} WHEN extra > 0 THEN inner_var / extra - 1
    ELSE {MOST_STRENGTH} END, {LEAST_STRENGTH}), {MOST_STRENGTH}) strength
  FROM (SELECT sum(br - pages * m * m - (k - 1) * m * (1 - m)) extra, sum(w * m * (1 - m)) AS inner_var
    FROM (SELECT *, bad / pages m, pages - nn / pages w FROM {groups} WHERE k > 1)))"""


def _url_reputation() -> str:
    rules = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [
        f"(host = {_text(h)} OR ends_with(host, {_text('.' + h)})) AND starts_with(path, {_text(p)})" for _, h, p in rules
    ]
    rule = " ".join(f"WHEN {f} THEN {_text(h + p)}" for f, (_, h, p) in zip(fits, rules))
    verdict = " ".join(f"WHEN {f} THEN {_text(v)}" for f, (v, _, _) in zip(fits, rules))
    return f"""
WITH parsed AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') path FROM pages),
hosts AS (
  SELECT host, count(*) pages, sum(greatest(1 - quality, toxic)) bad,
    array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain, string_split(host, '.')[-1] suffix
  FROM parsed JOIN labels ON doc_id = page_id WHERE greatest(1 - quality, toxic) IS NOT NULL GROUP BY host),
{_sums("hosts", "domain, suffix", "domains")},
{_sums("domains", "suffix", "suffixes")},
{_sums("suffixes", "", "root")},
{_strength("root", "s1")}, {_strength("suffixes", "s2")}, {_strength("domains", "s3")},
p1 AS (SELECT s.*, (r.bad - s.bad + 1) / (r.pages - s.pages + 2) prior FROM suffixes s, root r),
p2 AS (SELECT d.*, (p.bad - d.bad + strength * p.prior) / (p.pages - d.pages + strength) prior
  FROM domains d JOIN p1 p USING (suffix), s1),
p3 AS (SELECT h.*, (p.bad - h.bad + strength * p.prior) / (p.pages - h.pages + strength) prior
  FROM hosts h JOIN p2 p USING (domain, suffix), s2),
bounds AS (SELECT host, (bad + strength * prior) / (pages + strength) mean, pages + strength weight FROM p3, s3),
blocked AS (SELECT host FROM bounds WHERE mean - {SIGMAS} * sqrt(mean * (1 - mean) / (weight + 1)) > {BAD_LIMIT})
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict
FROM parsed"""


_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""

_DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
cut AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s FROM cut),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes),
hits AS (SELECT r, i, p.n, item_id FROM (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s FROM places) p
  JOIN windows USING (n, s)),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)"""


def _secrets() -> str:
    parts = []
    for rank, (kind, (pattern, group, least)) in enumerate(secrets.RULES.items()):
        p = _text(pattern)
        parts.append(f"""
SELECT r, {rank} AS kind_rank, {_text(kind)} AS kind, k,
  list_sum(list_transform(gaps[1:k], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:k - 1], lambda f: length(f))), 0) AS a,
  length(found[k]) AS n
FROM (SELECT r, gaps, found, counted, unnest(range(1, len(found) + 1)) AS k FROM (
  SELECT r, string_split_regex(t, {p}) AS gaps, regexp_extract_all(t, {p}) AS found, regexp_extract_all(t, {p}, {group}) AS counted
  FROM d)) WHERE length(counted[k]) >= {least}""")
    spans = "kind || ':' || a || ':' || (a + n)"
    counts = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.BASE)
    sums = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(parts)}),
g AS (SELECT r, {sums}, string_agg({spans}, ',' ORDER BY a, kind_rank) FILTER (kind IN {secrets.BASE}) AS base,
  string_agg({spans}, ',' ORDER BY a, kind_rank) AS spans FROM s GROUP BY r)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)"""


def _places(phrase: list[str]) -> str:
    return f"list_filter(range(0, len(w)), lambda i: list_slice(w, i + 1, i + {len(phrase)}) = {_list(phrase)})"


def _licenses() -> str:
    base = [(p.split(), label) for p, label in licenses.PHRASES]
    starts = ", ".join(_places(p) for p, _ in base)
    shares = []
    for label, (template, mandatory) in licenses.TEMPLATES.items():
        t, m = template.split(), mandatory.split()
        offset = next(k for k in range(len(t)) if t[k : k + len(m)] == m) if m else 0
        hits = " + ".join(
            f"CASE WHEN i - {offset} + {k} >= 0 AND w[i - {offset} + {k} + 1] = {_text(x)} THEN 1 ELSE 0 END" for k, x in enumerate(t)
        )
        shares.append(f"{{'label': {_text(label)}, 'share': list_max(list_transform({_places(m)}, lambda i: ({hits}) / {len(t)}::DOUBLE))}}")
    labels = ", ".join(f"CASE WHEN len(b[{k + 1}]) > 0 THEN {_text(label)} END" for k, (_, label) in enumerate(base))
    return f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
f AS (SELECT doc_id, w, [{starts}] AS b, list_filter([{', '.join(shares)}], lambda h: h.share IS NOT NULL) AS held FROM d),
l AS (SELECT doc_id, len(w) AS n_words, flatten(b) AS starts, held,
  list_sort(list_distinct(list_filter([{labels}], lambda x: x IS NOT NULL))) AS base FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(starts) AS BIGINT) AS n_base,
  list_min(starts) AS first_word, list_max(starts) AS last_word, array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, list_transform(held, lambda h: h.label)))), ',') AS labels,
  CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE coalesce(list_max(list_transform(held, lambda h: h.share)), 0.0)::DOUBLE END AS score
FROM l"""


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(UPPER, LOWER)

_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
f AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM t, s GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 100 - 90 + (90 * len(w) * n_docs) // n_terms AS m FROM d, s),
scored AS (SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""

# CRC-32 of UTF-8 bytes: the table of 256 entries follows from the polynomial.
_IMPORTANCE = f"""
WITH RECURSIVE steps(b, k, c) AS (
  SELECT b, 0, b FROM (SELECT unnest(range(0, 256))::BIGINT AS b)
  UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS tab FROM steps WHERE k = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM d) GROUP BY r, word),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest({_WORDS}) AS word FROM benchmark) GROUP BY word),
bytes AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
hashed AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc),
sb AS (SELECT bucket, sum(n)::BIGINT AS n FROM dw JOIN hashed USING (word) GROUP BY bucket),
tb AS (SELECT bucket, sum(n)::BIGINT AS n FROM bw JOIN hashed USING (word) GROUP BY bucket),
tot AS (SELECT coalesce((SELECT sum(n) FROM sb), 0)::BIGINT AS s_all, coalesce((SELECT sum(n) FROM tb), 0)::BIGINT AS t_all),
gains AS (SELECT bucket, floor(1000 * ln(((coalesce(tb.n, 0) + 1) * (s_all + 10000))::DOUBLE / ((sb.n + 1) * (t_all + 10000))))::BIGINT AS gain
  FROM sb LEFT JOIN tb USING (bucket), tot),
weighed AS (SELECT r, sum(n * gain)::BIGINT AS weight FROM dw JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
  (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN weighed USING (r)),
able AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS size FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * size // 100 THEN rank END AS rank FROM scored LEFT JOIN able USING (r)"""

_SPACED = "regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\\x20\\x09-\\x0D]+')".format(UPPER, LOWER)

_MINHASH = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y USING (s) GROUP BY ALL)
  JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE 100 * common >= 85 * (p.n + q.n - common)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_reputation": _url_reputation(),
        "op4_top_k": _TOP_K,
        "op6_decontaminate": _DECONTAMINATE,
        "op8_secrets": _secrets(),
        "op10_licenses": _licenses(),
        "op11_lexical_search": _SEARCH,
        "op12_importance": _IMPORTANCE,
        "op13_minhash": _MINHASH,
    }
