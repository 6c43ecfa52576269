"""SQL that states whole operators, for comparison on tables of moderate size."""

NGRAM_JACCARD_JOIN = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + 4), ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), near AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE same >= 0.8 * (x.n + y.n - same) - 1e-9
  UNION ALL SELECT x.doc_id, y.doc_id FROM w x JOIN w y ON x.doc_id < y.doc_id WHERE len(x.w) = 0 AND len(y.w) = 0
), links AS MATERIALIZED (SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, least(doc_id, coalesce(m, doc_id)) AS class_id, coalesce(n, 0) AS n_links
FROM w LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY 1) r ON r.a = doc_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY 1) l ON l.a = doc_id
"""

SUFFIX_ARRAY = """
WITH b AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), windows AS (SELECT doc_id, b, unnest(range(0, octet_length(b) - 199)) AS s FROM b WHERE octet_length(b) >= 200
), hashed AS (SELECT doc_id, s, md5(b[s + 1:s + 200]) AS h FROM windows
), starts AS (SELECT doc_id, s FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM hashed) WHERE n > 1
), steps AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 0 ELSE 1 END AS new FROM starts
), spans AS (SELECT doc_id, min(s) AS lo, max(s) + 200 AS hi FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM steps) GROUP BY doc_id, g
), parts AS (
  SELECT doc_id, lo, b[coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) + 1:lo] AS part FROM spans JOIN b USING (doc_id)
  UNION ALL SELECT doc_id, 1e18::BIGINT, b[hi + 1:octet_length(b)] FROM (SELECT doc_id, max(hi) AS hi FROM spans GROUP BY 1) JOIN b USING (doc_id)
), kept AS (SELECT doc_id, unhex(string_agg(hex(part), '' ORDER BY lo)) AS kept FROM parts GROUP BY 1
), sums AS (SELECT doc_id, sum(hi - lo) AS gone, count(*) AS n FROM spans GROUP BY 1)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans, sha256(coalesce(kept, b)) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

CROSS_ENTROPY_DIFFERENCE = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w,
    CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS good
  FROM documents
), tokens AS (
  SELECT r, good, len(w) AS n, unnest(w) AS word, unnest(list_prepend('', w[1:len(w) - 1])) AS before FROM docs WHERE len(w) > 0
), counted AS (
  SELECT r, good, n,
    count(*) OVER (PARTITION BY word) AS w1, sum(good) OVER (PARTITION BY word) AS w0, count(*) OVER (PARTITION BY r, word) AS wo,
    count(*) OVER (PARTITION BY before) AS c1, sum(good) OVER (PARTITION BY before) AS c0, count(*) OVER (PARTITION BY r, before) AS co,
    count(*) OVER (PARTITION BY before, word) AS p1, sum(good) OVER (PARTITION BY before, word) AS p0, count(*) OVER (PARTITION BY r, before, word) AS po
  FROM tokens
), whole AS (SELECT count(*) AS t1, sum(good) AS t0, (SELECT count(DISTINCT word) FROM tokens) AS v FROM tokens
), words AS (
  SELECT r, c0 - good * co AS c0, c1 - co AS c1, p0 - good * po AS p0, p1 - po AS p1,
    0.95::DOUBLE * (w0 - good * wo) / greatest(1, t0 - good * n) + 0.05::DOUBLE / v AS u0, 0.95::DOUBLE * (w1 - wo) / greatest(1, t1 - n) + 0.05::DOUBLE / v AS u1
  FROM counted, whole
), losses AS (
  SELECT r, avg(-ln(0.5::DOUBLE * CASE WHEN c0 > 0 THEN p0::DOUBLE / c0 ELSE u0 END + 0.5::DOUBLE * u0)) AS l0,
    avg(-ln(0.5::DOUBLE * CASE WHEN c1 > 0 THEN p1::DOUBLE / c1 ELSE u1 END + 0.5::DOUBLE * u1)) AS l1
  FROM words GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_tokens, round(l0, 6) AS target_loss, round(l1, 6) AS background_loss, round(l1 - l0, 6) AS score FROM docs LEFT JOIN losses USING (r)
"""

SPELLING_VARIANTS = r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents
), counted AS (SELECT doc_id, run, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x, count(*) AS n FROM runs WHERE len(run) >= 7 GROUP BY 1, 2
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, [('0x' || x[i:i + 1])::BIGINT FOR i IN range(1, len(x), 2)]), lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8))) AS h FROM counted, crc
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, n FROM hashed) WHERE len(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2
), cut AS MATERIALIZED (SELECT word, p, word[:p - 1] || word[p + 1:] AS rest FROM (SELECT word, unnest(range(1, len(word) + 1)) AS p FROM words)
), pairs AS (
  SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.p = y.p AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON rest = words.word UNION SELECT words.word, cut.word FROM cut JOIN words ON rest = words.word
), near AS (SELECT a, count(*) AS n_near, first(struct_pack(w := b, n := n) ORDER BY n DESC, b) AS best FROM pairs JOIN words ON word = b GROUP BY 1
), formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 10 * n THEN best.w END AS form, CASE WHEN best.n >= 10 * n THEN best.n END AS form_n FROM words LEFT JOIN near ON a = word
), path(word, top) AS (SELECT word, word FROM words UNION ALL SELECT p.word, form FROM path p JOIN formed f ON p.top = f.word WHERE form IS NOT NULL)
SELECT f.word, f.form, top AS root, f.n, f.n_near, f.form_n FROM formed f JOIN path p USING (word) JOIN formed l ON l.word = top AND l.form IS NULL
"""

FILTER_AUDIT = r"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), first AS (SELECT t, min(doc_id) AS m FROM docs GROUP BY 1
), good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1), toxic AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1
), failed AS MATERIALIZED (
  SELECT part, doc_id IN (SELECT doc_id FROM good) AS good, doc_id IN (SELECT doc_id FROM toxic) AS toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t), regexp_matches(t, '[#$%&*|]'), doc_id > m] AS f
  FROM docs JOIN first USING (t)
), cells AS MATERIALIZED (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY 1, 2
), walk(prefix) AS (SELECT '' UNION ALL SELECT prefix || l FROM walk, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE NOT contains(prefix, l)
), met AS (
  SELECT prefix, part, n, good, toxic, f[ord(prefix[-1]) - 64] AS fails, list_bool_or(list_prepend(false, [f[ord(c) - 64] FOR c IN string_split(prefix[:-2], '') IF c <> ''])) AS before,
    len(list_filter(f, lambda x: x)) AS failing
  FROM walk, cells WHERE prefix <> ''
), steps AS MATERIALIZED (
  SELECT prefix, part, sum(n) FILTER (NOT before AND NOT fails) AS kept, sum(n) FILTER (fails AND NOT before) AS removed, sum(n) FILTER (fails AND before) AS redundant,
    sum(n) FILTER (fails AND failing = 1) AS only_this, sum(good) FILTER (fails AND NOT before) AS good_lost, sum(toxic) FILTER (fails AND NOT before) AS toxic_lost
  FROM met GROUP BY 1, 2
), orders AS (SELECT prefix AS filter_order, unnest(range(1, 6)) AS step FROM walk WHERE len(prefix) = 5)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(only_this, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, filter_order[step]), 0)::BIGINT AS shapley
FROM orders JOIN steps ON prefix = filter_order[:step]
"""


def spotsigs_near_duplicates() -> str:
    from evgraph.llm.spotsigs import ANCHORS

    common = ", ".join(f"'{w}'" for w in sorted({w for words in ANCHORS for w in words.split()}))
    return rf"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM documents
), tokens AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs
), placed AS MATERIALIZED (SELECT *, word IN ({common}) AS anchor, count(*) FILTER (word NOT IN ({common})) OVER (PARTITION BY r ORDER BY i) AS c FROM tokens
), chains AS MATERIALIZED (
  SELECT DISTINCT a.r, a.word || ' ' || x.word || ' ' || y.word AS g
  FROM placed a JOIN placed x ON x.r = a.r AND x.c = a.c + 1 AND NOT x.anchor JOIN placed y ON y.r = a.r AND y.c = a.c + 2 AND NOT y.anchor WHERE a.anchor
), sets AS MATERIALIZED (
  SELECT r, g FROM chains UNION ALL SELECT r, 'whole ' || array_to_string(w, ' ') FROM docs WHERE r NOT IN (SELECT r FROM chains)
), sizes AS (SELECT r, count(*) AS n FROM sets GROUP BY 1
), pairs AS (SELECT a.r AS a, b.r AS b, count(*) AS same FROM sets a JOIN sets b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2
), near AS (SELECT a, b FROM pairs JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE same >= 0.8 * (x.n + y.n - same) - 1e-9
), links AS MATERIALIZED (SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, least(doc_id, coalesce(m, doc_id)) AS class_id
FROM docs LEFT JOIN (SELECT a, min(doc_id) AS m FROM reach JOIN docs ON r = b GROUP BY 1) ON a = r
"""


def license_scan() -> str:
    from evgraph.llm.license_rules import CONFIDENCE, rules
    from evgraph.llm.licenses import BASE, MENTION, spaced

    table = ", ".join(f"({r.number}, {r.tier}, '{r.label}', {r.keywords}, '{spaced(r.pattern)}')" for r in rules())
    phrase = lambda p: f"l[i:i + {p.count(' ')}] = {p.split(' ')!r}"
    sure = "CASE min(tier) " + " ".join(f"WHEN {t} THEN {c}" for t, c in CONFIDENCE.items()) + " END"
    words = lambda x: f"len(list_filter(string_split({x}, ' '), lambda y: y <> ''))"
    return rf"""
WITH rules AS MATERIALIZED (SELECT * FROM (VALUES {table}) t(number, tier, label, keywords, pattern)
), docs AS MATERIALIZED (
  SELECT *, ' ' || array_to_string(l, '  ') || ' ' AS w FROM (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS l FROM documents)
), base AS MATERIALIZED (
  SELECT r, unnest(list_filter(range(1, len(l) + 1), lambda i: {" OR ".join(map(phrase, BASE))})) - 1 AS place FROM docs
), named AS (SELECT r, place, CASE l[place + 1] {" ".join(f"WHEN '{p.split(' ')[0]}' THEN '{label}'" for p, label in BASE.items())} END AS label FROM base JOIN docs USING (r)
), met AS (SELECT r, number, tier, label, regexp_extract_all(w, pattern) AS m, string_split_regex(w, pattern) AS p FROM docs JOIN rules ON list_has_all(l, keywords)
), places AS (SELECT r, number, tier, label, i, {words("p[i]")} AS gap, {words("m[i]")} AS size FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM met)
), spans AS MATERIALIZED (SELECT r, number, tier, label, e - size AS s, e FROM (SELECT *, sum(gap + size) OVER (PARTITION BY r, number ORDER BY i) AS e FROM places)
), stands AS MATERIALIZED (
  SELECT * FROM spans d WHERE NOT EXISTS (FROM spans x WHERE x.r = d.r AND x.s <= d.s AND x.e >= d.e AND (x.tier < d.tier OR x.tier = d.tier AND (x.e - x.s > d.e - d.s OR x.e - x.s = d.e - d.s AND x.number < d.number)))
), firm AS (SELECT r, count(*) AS n_detections, {sure}::DOUBLE AS sure FROM stands GROUP BY 1
), placed AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM named GROUP BY 1
), labelled AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM named UNION ALL SELECT r, label FROM stands) GROUP BY 1)
SELECT doc_id, len(l)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(n_detections, 0)::BIGINT AS n_detections,
  coalesce(sure, CASE WHEN n_base > 0 THEN {MENTION} ELSE 0 END)::DOUBLE AS score
FROM docs LEFT JOIN placed USING (r) LEFT JOIN labelled USING (r) LEFT JOIN firm USING (r)
"""
