"""SQL twins of the operators that SQL can express."""

from lakeops.llm.urls import RULES, SOFT, SOFT_LIMIT, STRICT

QUALITY = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS l
  FROM documents
),
grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT r, count(*) AS n_repeat_words
  FROM (SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(l) AS n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals
  FROM d LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * n_words
    OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 100 * n_dup_lines > 40 * n_lines
    OR 100 * n_capitals > 30 * word_chars) AS kept
FROM m
"""


def _spans(rank: int, kind: str, pattern: str, valid: str) -> str:
    return f"""
  SELECT r, {rank} AS k, '{kind}' AS kind, s, s + length(m) AS e, m FROM (
    SELECT r, unnest(matches) AS m, unnest(list_transform(range(1, len(matches) + 1), lambda i:
      list_sum(list_transform(gaps[1:i], lambda x: length(x))) +
      coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0)))::BIGINT AS s
    FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS matches, regexp_split_to_array(t, '{pattern}') AS gaps FROM d)
  ) WHERE {valid}"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = (
    f"length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 "
    f"THEN reverse({_DIGITS})[i]::INT WHEN reverse({_DIGITS})[i]::INT > 4 THEN reverse({_DIGITS})[i]::INT * 2 - 9 "
    f"ELSE reverse({_DIGITS})[i]::INT * 2 END)) % 10 = 0"
)

# The kinds that the method adds need look-around, which this dialect lacks; the tables hold none of them.
PERSONAL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_spans(0, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true")}
  UNION ALL {_spans(1, "ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda x: x::HUGEINT)) <= 255")}
  UNION ALL {_spans(2, "card", r"[0-9](?:[ -]?[0-9])+", _LUHN)}
  UNION ALL {_spans(3, "phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15")}
),
joined AS (
  SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
    count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
  FROM found GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip,
  coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (r)
"""

NEAR = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
),
link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION
  SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)
"""


def _terms(terms) -> str:
    return "len(list_filter([" + ", ".join(f"'{t}'" for t in terms) + r"], lambda t: regexp_matches(u, '(^|[^\pL\pN])' || t || '([^\pL\pN]|$)')))"


def _rule(rule: str) -> str:
    domain, slash, start = rule.partition("/")
    return f"WHEN (host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash}{start}') THEN '{rule}'"


URLS = rf"""
WITH parsed AS (
  SELECT page_id, lower(coalesce(url, '')) AS u,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
),
ruled AS (
  SELECT *, CASE {" ".join(_rule(r) for r in sorted(RULES, key=len, reverse=True))} END AS rule FROM parsed
)
SELECT page_id, host, path, rule, CASE
  {" ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in RULES.items())}
  WHEN {_terms(STRICT)} >= 1 OR {_terms(SOFT)} >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

_BASE32 = (
    "array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    "(((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1), 1)), '')"
)

ARCHIVES = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS holder FROM p)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM q
"""

COLLOCATIONS = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
),
piece AS (SELECT lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\n-\r]')) AS p FROM d)),
spot AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece),
gram AS (
  SELECT lang, 1 AS m, w[i] AS phrase FROM spot
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM spot WHERE i < len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM spot WHERE i < len(w) - 1
),
f AS (SELECT lang, m, phrase, count(*)::HUGEINT AS a FROM gram GROUP BY ALL),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 10),
inner_ AS (
  SELECT lang, part, max(a) AS most FROM (
    SELECT lang, a, w[1] || ' ' || w[2] AS part FROM c WHERE m = 3
    UNION ALL SELECT lang, a, w[2] || ' ' || w[3] FROM c WHERE m = 3) GROUP BY ALL
),
alone AS (
  SELECT c.* FROM c LEFT JOIN inner_ ON inner_.lang = c.lang AND part = phrase WHERE most IS NULL OR 100 * most < 50 * a
),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:m], ' ') AS y
  FROM (SELECT *, unnest(range(1, m)) AS k FROM alone)
),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, k, fx.a AS l, fy.a AS r, (1000000 * cut.a * cut.a) // (fx.a * fy.a) AS score
  FROM cut JOIN f fx ON fx.lang = cut.lang AND fx.phrase = x JOIN f fy ON fy.lang = cut.lang AND fy.phrase = y
),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest),
total AS (SELECT lang, sum(a) AS n FROM f WHERE m = 1 GROUP BY lang)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

AUDIT = r"""
WITH RECURSIVE lab AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
),
t AS (
  SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN len(w) < 100
      WHEN 'B' THEN 100 * len(list_distinct(w)) < 80 * len(w)
      WHEN 'C' THEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t)
      WHEN 'D' THEN regexp_matches(t, '[#$%&*|]') ELSE coalesce(doc_id > first_id, false) END) AS fails
  FROM t LEFT JOIN lab USING (doc_id)
),
orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE length(o) < 5 AND NOT contains(o, x)
),
place AS (SELECT o, unnest(range(1, 6)) AS step FROM orders WHERE length(o) = 5),
kinds AS (SELECT part, fails, good, toxic, count(*) AS n FROM m GROUP BY ALL),
each AS (
  SELECT part, o, step, n, good, toxic, fails, substr(o, step, 1) AS x, list_contains(fails, substr(o, step, 1)) AS bad,
    len(list_filter(fails, lambda f: contains(substr(o, 1, step - 1), f))) > 0 AS gone
  FROM kinds, place
)
SELECT part, o AS filter_order, step::INT AS step, sum(CASE WHEN NOT bad AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN bad AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN bad AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN fails = [x] THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN bad AND NOT gone AND good = 1 THEN n ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN bad AND NOT gone AND toxic = 1 THEN n ELSE 0 END)::BIGINT AS toxic_lost,
  sum(CASE WHEN bad THEN n * 120 // len(fails) ELSE 0 END)::BIGINT AS shapley
FROM each GROUP BY ALL
"""
