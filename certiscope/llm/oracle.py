"""Expected answers in DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from certiscope.llm.mixing import KEEP, ROUNDS, TEMPER

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URL_VERDICTS = f"""
WITH parts AS (
  SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""

CHAT = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
speakers AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
seen AS (
  SELECT said.*, perspective, speaker = perspective AS own,
         CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN speaker ELSE 'user' END AS role,
         CASE WHEN speaker <> perspective AND speaker <> 'system' THEN speaker END AS name
  FROM said JOIN speakers ON said.conv_id IS NOT DISTINCT FROM speakers.conv_id),
headed AS (SELECT *, '<|' || role || coalesce(' name=' || name, '') || '|>' || chr(10) AS head, own AND text <> '' AS learn FROM seen)
SELECT conv_id, perspective, turn, role, name, head || text || '<|end|>' || chr(10) AS segment, learn,
       CASE WHEN learn THEN length(head) ELSE 0 END::BIGINT AS mask_start,
       CASE WHEN learn THEN length(head) + length(text) + 7 ELSE 0 END::BIGINT AS mask_end
FROM headed
"""

_IBAN = "[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
_FOUND = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"), ("iban", _IBAN),
]


def _found(rank: int, kind: str, pattern: str) -> str:
    """All matches of a kind with their places: what lies between matches comes from the text cut at them."""
    group = pattern.replace("(?:", "(").replace("(", "(?:")
    return f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, m[i] AS value,
         list_sum(list_transform(b[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT AS start
  FROM (SELECT doc_id, m, b, unnest(range(1, len(m) + 1)) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '{group}') AS m, regexp_split_to_array(text, '{group}') AS b FROM texts))"""


PERSONAL_DATA = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_found(k, *x) for k, x in enumerate(_FOUND))}),
measured AS (
  SELECT *, start + length(value) AS stop, regexp_replace(value, '[^0-9]', '', 'g') AS digits,
         substr(replace(value, ' ', ''), 5) || substr(replace(value, ' ', ''), 1, 4) AS moved
  FROM found),
valid AS (
  SELECT * FROM measured WHERE CASE kind
    WHEN 'ip' THEN list_bool_and(list_transform(string_split(value, '.'), lambda p: coalesce(try_cast(p AS HUGEINT), 999) <= 255))
    WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda k:
      CASE WHEN k % 2 = 0 THEN (2 * substr(reverse(digits), k, 1)::INT) // 10 + (2 * substr(reverse(digits), k, 1)::INT) % 10
           ELSE substr(reverse(digits), k, 1)::INT END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
    WHEN 'iban' THEN length(moved) BETWEEN 15 AND 34 AND list_reduce(list_transform(range(1, length(moved) + 1), lambda k:
      CASE WHEN ascii(substr(moved, k, 1)) >= 65 THEN 100000 + ascii(substr(moved, k, 1)) - 55 ELSE substr(moved, k, 1)::INT END),
      lambda a, c: CASE WHEN c >= 100000 THEN (a * 100 + c - 100000) % 97 ELSE (a * 10 + c) % 97 END, 0) = 1
    ELSE true END),
lists AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip, count(*) FILTER (rank = 2) AS n_card,
         count(*) FILTER (rank = 3) AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM valid GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN lists USING (doc_id)
"""


def _mixing(rounds: int = ROUNDS) -> str:
    """Raking written out: the rounds of the operator."""
    steps, last = [], "w0"
    for k in range(rounds):
        for d in ("source", "lang", "topic"):
            name = f"w{k + 1}_{d}"
            steps.append(f"""{name} AS MATERIALIZED (
  SELECT source, lang, topic, tokens, weight * (SELECT target FROM t_{d} WHERE t_{d}.{d} IS NOT DISTINCT FROM {last}.{d}) / sum(weight) OVER (PARTITION BY {d}) AS weight
  FROM {last})""")
            last = name
    targets = ",\n".join(f"""t_{d} AS MATERIALIZED (
  SELECT {d}, pow(sum(tokens)::DOUBLE, {TEMPER}) / sum(pow(sum(tokens)::DOUBLE, {TEMPER})) OVER () AS target FROM cells GROUP BY {d})"""
                         for d in ("source", "lang", "topic"))
    return f"""
WITH texts AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
measured AS MATERIALIZED (
  SELECT doc_id, source, lang, CASE
      WHEN regexp_matches(text, '(?i)licen[cs]e|copyright') THEN 'notice' WHEN contains(text, '@') THEN 'contact'
      WHEN length(text) > 0 AND 20 * length(regexp_replace(text, '[^0-9]', '', 'g')) >= length(text) THEN 'data'
      WHEN len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) < 200 THEN 'passage' ELSE 'prose' END AS topic,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens,
    ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(text)), 1, 12))::BIGINT AS draw
  FROM texts),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM measured WHERE tokens > 0 GROUP BY ALL),
{targets},
w0 AS MATERIALIZED (SELECT source, lang, topic, tokens, tokens::DOUBLE AS weight FROM cells),
{",".join(steps)},
factors AS MATERIALIZED (SELECT source, lang, topic, tokens, weight / tokens AS factor FROM {last}),
scales AS (
  SELECT factor, ({KEEP} * (SELECT sum(tokens) FROM factors) - coalesce(sum(tokens) OVER (ORDER BY factor DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(tokens * factor) OVER (ORDER BY factor DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale
  FROM factors),
chances AS (SELECT source, lang, topic, least(1.0, factor * (SELECT scale FROM scales WHERE factor * scale < 1 ORDER BY factor DESC LIMIT 1)) AS chance FROM factors),
joined AS (
  SELECT m.*, round(CASE WHEN m.tokens > 0 THEN coalesce(chance, 0) ELSE 0 END, 9) AS probability
  FROM measured m LEFT JOIN chances c ON m.source IS NOT DISTINCT FROM c.source AND m.lang IS NOT DISTINCT FROM c.lang AND m.topic = c.topic)
SELECT doc_id, source, lang, topic, tokens, probability, draw < probability * {float(16**12)} AS sampled FROM joined
"""


SQL = {
    "op2_url_filter_cascade": URL_VERDICTS,
    "op6_source_mixing": _mixing(),
    "op7_chat_perspectives": CHAT,
    "op8_personal_data": PERSONAL_DATA,
}

LINE_DEDUP = """
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT row_no, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS k FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS owner FROM (SELECT DISTINCT key, doc_id FROM keyed WHERE length(key) >= 40)
  GROUP BY key HAVING count(doc_id) >= 5),
judged AS (
  SELECT keyed.*, frequent.key IS NOT NULL AND owner IS DISTINCT FROM doc_id AS dropped
  FROM keyed LEFT JOIN frequent USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY row_no, doc_id
"""

SQL["op12_line_dedup"] = LINE_DEDUP

_TERMS = ("regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

LEXICAL_SEARCH = f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, {_TERMS.format("text")} AS terms FROM documents),
counted AS (SELECT *, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM counted),
tf AS (SELECT row_no, term, count(*)::BIGINT AS tf FROM (SELECT row_no, unnest(terms) AS term FROM counted) GROUP BY row_no, term),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
items AS (SELECT DISTINCT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark),
weights AS (SELECT item_id, term, floor(1000 * ln((2 * big_n + 2) / (2 * df + 1)))::BIGINT AS w FROM items JOIN df USING (term), totals),
scored AS (
  SELECT item_id, row_no, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score
  FROM weights JOIN tf USING (term) JOIN counted USING (row_no), totals GROUP BY item_id, row_no),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS place
  FROM scored JOIN counted USING (row_no) WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 50
"""

SQL["op13_lexical_search"] = LEXICAL_SEARCH

COLLOCATIONS = """
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM docs),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, unnest(list_concat(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])),
                                  list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS phrase
  FROM words),
counts AS (SELECT lang, phrase, count(*)::BIGINT AS f FROM grams GROUP BY lang, phrase),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
cand AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE len(string_split(phrase, ' ')) >= 2 AND f >= 10),
cuts AS (SELECT lang, phrase, a, w, unnest(range(1, len(w))) AS k FROM cand),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, ((c.a::HUGEINT * c.a * 1000000) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM scored) WHERE pick = 1),
covering AS (
  SELECT lang, sub AS phrase, max(a) AS longer
  FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS sub FROM cand WHERE len(w) = 3) GROUP BY lang, sub),
kept AS (
  SELECT best.lang, best.phrase, a, l, r, n, score FROM best LEFT JOIN covering USING (lang, phrase) JOIN totals USING (lang)
  WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase ASC)::BIGINT AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

SQL["op11_collocations"] = COLLOCATIONS
