"""DuckDB SQL for the queries of this subpackage that SQL can express, written on its own."""

from __future__ import annotations

SPLIT = r"list_filter(string_split_regex({t}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
WORDS = SPLIT.format(t="coalesce(text, '')")

# --------------------------------------------------------------------- op1
OP1 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
o AS MATERIALIZED (
  SELECT doc_id, i, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] END AS v, CASE WHEN i > 2 THEN w[i - 2] END AS u
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
uni AS (SELECT w, count(*) AS n FROM o GROUP BY w),
ctx AS (SELECT w AS v, n FROM uni UNION ALL SELECT NULL, count(*) FROM o WHERE v IS NULL),
bi AS (SELECT v, w, count(*) AS n FROM o GROUP BY v, w),
tri AS (SELECT u, v, w, count(*) AS n FROM o WHERE i > 1 GROUP BY u, v, w),
s AS (
  SELECT o.doc_id, ln(CASE WHEN tri.n >= 2 THEN tri.n::DOUBLE / two.n
                           WHEN bi.n >= 2 THEN CASE WHEN i > 1 THEN 0.4 ELSE 1.0 END * bi.n::DOUBLE / ctx.n
                           ELSE CASE WHEN i > 1 THEN 0.4 * 0.4 ELSE 0.4 END * uni.n::DOUBLE / (SELECT count(*) FROM o) END) AS x
  FROM o JOIN bi ON bi.v IS NOT DISTINCT FROM o.v AND bi.w = o.w
  JOIN ctx ON ctx.v IS NOT DISTINCT FROM o.v JOIN uni ON uni.w = o.w
  LEFT JOIN tri ON o.i > 1 AND tri.u IS NOT DISTINCT FROM o.u AND tri.v = o.v AND tri.w = o.w
  LEFT JOIN bi two ON o.i > 1 AND two.v IS NOT DISTINCT FROM o.u AND two.w = o.v),
t AS (SELECT doc_id, count(*) AS n, sum(x) AS x FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.n, 0)::BIGINT AS n_words, round(coalesce(t.x, 0.0), 4) AS log_score,
  round(coalesce(t.x / t.n, 0.0), 6) AS mean_log_score
FROM d LEFT JOIN t USING (doc_id)
"""

# --------------------------------------------------------------------- op2
_CLOSING = r"""[.!?:;…。！？]["''”’»)\]]*[\x20\x09-\x0D]*$"""
_NAVIGATION = (r"(?i)^\s*(home|menu|login|log in|sign in|sign up|next|previous|back to top|skip to content|share this)"
               r"\s*[.!|>]*\s*$")
_PHRASES = ("all rights reserved", "terms of service", "terms of use", "privacy policy", "cookie policy",
            "enable javascript", "released under the ", "licensed under ", "subscribe to our newsletter", "copyright ©")
_PHRASE_SQL = " OR ".join(f"contains(lower(line), '{p}')" for p in _PHRASES)

OP2 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
tri AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM tri) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
judged AS (
  SELECT doc_id, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS full_line,
    regexp_matches(line, '{_CLOSING}')
    AND NOT (length(line) >= 20 AND upper(line) = line AND lower(line) <> line)
    AND NOT regexp_matches(line, '{_NAVIGATION}')
    AND length(regexp_replace(line, '[^|>»•]', '', 'g')) < 3
    AND length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) * 100 <= length(line) * 8
    AND NOT ({_PHRASE_SQL}) AS good
  FROM lines),
per AS (
  SELECT doc_id, count(*) FILTER (full_line) - count(DISTINCT line) FILTER (full_line) AS n_dup_lines,
    count(*) FILTER (full_line AND NOT good) AS n_removed_lines,
    coalesce(sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) FILTER (full_line AND NOT good), 0) AS lost_chars
  FROM judged GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, per.n_dup_lines::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, per.n_removed_lines::BIGINT AS n_removed_lines,
    per.lost_chars::BIGINT AS lost_chars
  FROM d JOIN per USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_chars <= 30 * word_chars AS kept,
  n_removed_lines, lost_chars
FROM base
"""

# --------------------------------------------------------------------- op3
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {SPLIT.format(t=_LOW)} AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- sets of equal content first, so that copies meet once
sets AS MATERIALIZED (SELECT doc_id, md5(string_agg(g, chr(10) ORDER BY g)) AS k FROM s GROUP BY doc_id),
first AS MATERIALIZED (SELECT k, min(doc_id) AS rep, count(*) AS copies FROM sets GROUP BY k),
fs AS MATERIALIZED (SELECT s.doc_id, s.g FROM s JOIN first ON s.doc_id = first.rep),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM fs x JOIN fs y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),
reach AS (
  SELECT rep AS a, rep AS b FROM first
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
near AS (SELECT links.a, sum(first.copies) AS n FROM links JOIN first ON first.rep = links.b GROUP BY links.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(comp.component_id, d.doc_id) AS component_id,
  (coalesce(first.copies - 1, 0) + coalesce(near.n, 0))::BIGINT AS n_links
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN sets USING (doc_id) LEFT JOIN first USING (k)
LEFT JOIN comp ON comp.a = first.rep LEFT JOIN near ON near.a = first.rep
"""

# --------------------------------------------------------------------- op4
OP4 = """
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(role) + 1 + length(replace(t, '<|', '<||')) + length('<|im_end|>') + 1)::BIGINT
    AS formatted_chars
FROM c GROUP BY conv_id
"""

# --------------------------------------------------------------------- op5
_DIMS = {"source": 0.7, "lang": 0.8, "topic": 0.9}


def _raked(d: str, inner: str) -> str:
    """One dimension's step: the factors of its values from window sums over their cells."""
    other = " * ".join(f"f_{x}" for x in _DIMS if x != d)
    now = " * ".join(f"f_{x}" for x in _DIMS)
    return f"""
  SELECT * EXCLUDE (f_{d}, e_{d}, plain, drawn, cut, open), miss AS e_{d},
    CASE WHEN plain > 0 AND miss > 1e-12
         THEN greatest(t_{d} / plain, CASE WHEN open > 0 THEN (t_{d} - cut) / open END) ELSE f_{d} END AS f_{d}
  FROM (SELECT * EXCLUDE (miss), CASE WHEN t_{d} > 0 THEN abs(drawn / t_{d} - 1) ELSE 0 END AS miss
  FROM (SELECT *, sum({other} * tokens) OVER v AS plain, sum(least(1.0, {now}) * tokens) OVER v AS drawn,
    sum(CASE WHEN {now} >= 1 THEN tokens ELSE 0 END) OVER v AS cut,
    sum(CASE WHEN {now} < 1 THEN {other} * tokens ELSE 0 END) OVER v AS open FROM ({inner}) WINDOW v AS (PARTITION BY {d})))"""


def _mixing() -> str:
    steps = [f"""
m AS MATERIALIZED (
  SELECT doc_id, source, lang, n_tokens,
    CASE WHEN length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) * 20 > length(t) THEN 'marked'
         WHEN n_tokens < 100 THEN 'short' WHEN n_tokens >= 1000 THEN 'long'
         WHEN (len(string_split(t, chr(10))) - 1) * 120 > length(t) THEN 'lines' ELSE 'prose' END AS topic
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS t, len({WORDS})::BIGINT AS n_tokens FROM documents)),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM m GROUP BY ALL)"""]
    for d, e in _DIMS.items():
        # values in the order in which they run short; the right scale is the largest answer
        steps.append(f"""
have_{d} AS (SELECT {d} AS v, sum(tokens) AS h, pow(sum(tokens), {e}) AS r FROM cells GROUP BY {d}),
scale_{d} AS (
  SELECT max((0.6 * whole - gone) / rest) AS scale
  FROM (SELECT sum(h) OVER () AS whole, coalesce(sum(h) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone,
          sum(r) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
        FROM have_{d} WHERE h > 0 WINDOW w AS (ORDER BY r / h DESC, v))),
target_{d} AS MATERIALIZED (SELECT v, least(h, r * scale) AS t FROM have_{d}, scale_{d})""")
    facts = ", ".join(f"t_{d}.t AS t_{d}" for d in _DIMS)
    joins = " ".join(f"JOIN target_{d} t_{d} ON t_{d}.v IS NOT DISTINCT FROM c.{d}" for d in _DIMS)
    inner = ("SELECT * EXCLUDE (err), NULL::DOUBLE AS miss FROM it WHERE err IS NULL OR (err > 1e-4 AND idle < 3)")
    body = inner
    for k, d in enumerate(_DIMS):
        body = _raked(d, body if k == 0 else f"SELECT *, NULL::DOUBLE AS miss FROM ({body})")
    order = ("source, lang, topic, tokens, t_source, t_lang, t_topic, f_source, f_lang, f_topic, e_source, e_lang, e_topic, "
             "n, best, idle")
    names = order.replace("n, best, idle", "")
    steps.append(f"""
it AS (
  SELECT c.source, c.lang, c.topic, c.tokens, {facts}, 0.6::DOUBLE AS f_source, 1.0::DOUBLE AS f_lang, 1.0::DOUBLE AS f_topic,
    0.0::DOUBLE AS e_source, 0.0::DOUBLE AS e_lang, 0.0::DOUBLE AS e_topic, 0 AS n, NULL::DOUBLE AS best, 0 AS idle,
    NULL::DOUBLE AS err
  FROM cells c {joins}
  UNION ALL
  SELECT {names} n + 1, least(coalesce(best, err), err), CASE WHEN best IS NULL OR err < 0.99 * best THEN 0 ELSE idle + 1 END, err
  FROM (SELECT *, max(greatest(e_source, e_lang, e_topic)) OVER () AS err FROM ({body}))),
f AS MATERIALIZED (SELECT *, f_source * f_lang * f_topic AS p FROM it WHERE n = (SELECT max(n) FROM it))""")
    return "WITH RECURSIVE " + ",".join(steps) + """
SELECT m.doc_id, m.source, m.lang, m.topic, m.n_tokens, round(f.p / 0.6, 6) AS weight,
  round(least(1.0, f.p), 6) AS probability,
  ('0x' || substr(md5(m.doc_id::VARCHAR || ':mix'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 < least(1.0, f.p) AS kept
FROM m JOIN f ON f.source IS NOT DISTINCT FROM m.source AND f.lang IS NOT DISTINCT FROM m.lang AND f.topic = m.topic
"""


OP5 = _mixing()

# --------------------------------------------------------------------- op8
OP8 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""

# --------------------------------------------------------------------- crc32
# FIXED VALUES: the crc32 of the sixteen half bytes (reflected polynomial 0xEDB88320)
_NIBBLES = ("[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
            "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]")


def _crc32(codes: str) -> str:
    """Unsigned crc32 of a list of bytes, half a byte at a time."""
    half = f"xor(c >> 4, {_NIBBLES}[((c & 15) + 1)::INT]::BIGINT)"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform({codes}, lambda b: [b::BIGINT, -1::BIGINT]))), "
            f"lambda s, b: list_transform([CASE WHEN b < 0 THEN s ELSE xor(s, b) END], lambda c: {half})[1]), 4294967295::BIGINT)")


# --------------------------------------------------------------------- op11
OP11 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
h AS (SELECT doc_id, {_crc32("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x))")} AS h FROM documents),
g AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS changed, h // 10 AS g FROM d JOIN h USING (doc_id)),
a AS (SELECT *, CASE WHEN changed THEN g % n END AS a FROM g),
p AS (SELECT *, CASE WHEN changed THEN 1 + (n - a) // (3 + g % 8) END AS p FROM a),
o AS MATERIALIZED (
  SELECT doc_id, i, CASE WHEN changed AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS x
  FROM (SELECT *, unnest(range(0, n)) AS i FROM p)),
grams AS (
  SELECT doc_id, i, x || ' ' || lead(x, 1) OVER s || ' ' || lead(x, 2) OVER s || ' ' || lead(x, 3) OVER s
    || ' ' || lead(x, 4) OVER s || ' ' || lead(x, 5) OVER s AS six
  FROM o WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
again AS (
  SELECT b.doc_id, b.i, c.i - b.i AS q FROM grams b JOIN grams c
  ON b.doc_id = c.doc_id AND b.six = c.six AND b.i < c.i),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM again),
stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + 5 + q >= greatest(12, 2 * q)),
runs AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM stretch GROUP BY doc_id, start, length),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t
  FROM runs GROUP BY doc_id),
best AS (SELECT doc_id, start, length, period FROM runs
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT o.doc_id, string_agg(o.x, ' ' ORDER BY o.i) AS t FROM o LEFT JOIN gone ON gone.doc_id = o.doc_id AND gone.i = o.i
  WHERE gone.i IS NULL GROUP BY o.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(told.n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start,
  best.length::BIGINT AS length, best.period::BIGINT AS period, (1000 * best.length // best.period)::BIGINT AS exponent_milli,
  sha256(coalesce(told.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN told ON told.doc_id = d.doc_id LEFT JOIN best ON best.doc_id = d.doc_id
  LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

# --------------------------------------------------------------------- op12
_LOWERED = "translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BYTES = ("flatten(list_transform(string_split(doc_id::VARCHAR || ':' || r, ''), "
          "lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [195, ord(x) - 64] END))")

OP12 = rf"""
WITH RECURSIVE found AS (
  SELECT doc_id, {_LOWERED} AS r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS r FROM documents)
  GROUP BY ALL HAVING length(r) >= 6),
digest AS (SELECT r, n, {_crc32(_BYTES)} AS h FROM found),
vocab AS MATERIALIZED (
  SELECT w, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS w, n
        FROM digest)
  WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
place AS (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM vocab),
cut AS MATERIALIZED (SELECT w, n, i, substr(w, 1, i::INT - 1) AS pre, substr(w, i::INT + 1) AS post FROM place),
pair AS (
  SELECT a.w, b.w AS v, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.pre = b.pre AND a.post = b.post AND a.w <> b.w
  UNION SELECT c.w, v.w, v.n FROM cut c JOIN vocab v ON v.w = c.pre || c.post
  UNION SELECT v.w, c.w, c.n FROM cut c JOIN vocab v ON v.w = c.pre || c.post),
near AS (SELECT w, count(*) AS n_near FROM pair GROUP BY w),
top AS (SELECT w, v, n FROM pair QUALIFY row_number() OVER (PARTITION BY w ORDER BY n DESC, v) = 1),
form AS MATERIALIZED (
  SELECT vocab.w, CASE WHEN top.n >= 5 * vocab.n THEN top.v END AS form, CASE WHEN top.n >= 5 * vocab.n THEN top.n END AS form_n
  FROM vocab LEFT JOIN top USING (w)),
climb(w, top) AS (
  SELECT w, w FROM vocab
  UNION ALL SELECT climb.w, form.form FROM climb JOIN form ON form.w = climb.top WHERE form.form IS NOT NULL)
SELECT vocab.w AS word, form.form, climb.top AS root, vocab.n, coalesce(near.n_near, 0)::BIGINT AS n_near, form.form_n::BIGINT AS form_n
FROM vocab JOIN form USING (w) LEFT JOIN near USING (w) JOIN climb ON climb.w = vocab.w
  JOIN form last ON last.w = climb.top AND last.form IS NULL
"""

ORACLES = {
    "op1_lm_scoring": OP1,
    "op2_quality_rules": OP2,
    "op3_ngram_jaccard_join": OP3,
    "op4_chat_formatting": OP4,
    "op5_mixing_sources": OP5,
    "op8_exact_dedup": OP8,
    "op11_periodic_runs": OP11,
    "op12_spelling_variants": OP12,
}
