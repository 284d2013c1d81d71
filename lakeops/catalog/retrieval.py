"""Text rendering, embedding, vector and hybrid retrieval, page and feed extraction."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from lakeops.catalog.base import query, rounded, table
from lakeops.functions.text import clause, strip_markup
from lakeops.operators import markup as MK
from lakeops.operators import retrieval as V
from lakeops.plans import roles as R
from lakeops.session import materialise

ORDER_TEXT_SQL = """'Order ' || o_orderkey::VARCHAR || ' by ' || c_name || ' is ' || {state}
|| CASE WHEN o_totalprice > 300000 THEN '. High value, priority ' || o_orderpriority ELSE '' END
|| '. Meta {{"customer":' || o_custkey::VARCHAR || ',"segment":"' || c_mktsegment || '"}}'"""


def _order_text(spark, d, null_as):
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    state = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    meta = F.to_json(F.struct(F.col("o_custkey").alias("customer"), F.col("c_mktsegment").alias("segment")))
    parts = [
        "Order ", F.col("o_orderkey"), " by ", F.col("c_name"), " is ", state,
        clause(F.col("o_totalprice") > 300000, [". High value, priority ", F.col("o_orderpriority")]), ". Meta ", meta,
    ]
    return V.render_text(orders, parts, null_as=null_as).select("o_orderkey", "text")


@query(
    "render_order_text", "M1", "I1", "C16", "I25",
    sql=f"""SELECT o_orderkey, {ORDER_TEXT_SQL.format(state="CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END")} AS text
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def _(spark, d):
    return _order_text(spark, d, None)


@query(
    "render_order_text_null_safe", "M1",
    sql=f"""SELECT o_orderkey, {ORDER_TEXT_SQL.format(state="CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus ELSE '' END")} AS text
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def _(spark, d):
    return _order_text(spark, d, "")


@query(
    "render_sections", "M2", "C14",
    sql="""SELECT event_id, 'Session:' || chr(10) || 'Event: ' || event_id::VARCHAR || chr(10) || 'Kind: ' ||
    CASE WHEN event_type = 'view' THEN 'unknown' ELSE event_type END || chr(10) || 'Visitor:' || chr(10) || 'User: ' || user_id::VARCHAR AS text FROM events""",
)
def _(spark, d):
    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    sections = {"Session": {"Event": "event_id", "Kind": kind}, "Visitor": {"User": "user_id"}}
    return V.render_sections(R.events(spark, d), sections).select("event_id", "text")


@query("metadata_struct", "M3", sql="SELECT doc_id, lang, source, n_chars FROM documents")
def _(spark, d):
    rows = V.metadata_struct(table(spark, d, "documents"), ["lang", "source", "n_chars"])
    return rows.select("doc_id", "metadata.*")


def digest_model(texts: list[str]) -> list[list[float]]:
    """Stand-in model: four numbers from the digest of the whole text."""
    return [[b / 255 for b in hashlib.md5(t.encode()).digest()[:4]] for t in texts]


_DIGEST = ", ".join(f"round(('0x' || substr(md5(text), {2 * i + 1}, 2))::INT / 255, 6) AS v{i}" for i in range(4))


def _flat(df):
    return rounded(df.select("doc_id", *[F.col("embedding")[i].alias(f"v{i}") for i in range(4)]))


@query("embed_with_model", "M4", "N2", "F3", sql=f"SELECT doc_id, {_DIGEST} FROM documents")
def _(spark, d):
    return _flat(V.embed(table(spark, d, "documents"), "doc_id", "text", digest_model))


@query(
    "embed_hashed_tfidf", "M4",
    sql=r"SELECT doc_id, 64 AS dims, CASE WHEN regexp_matches(text, '[\p{L}\p{N}]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS length FROM documents",
)
def _(spark, d):
    e = V.hash_embed(table(spark, d, "documents"), "doc_id", "text", 64)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    return rounded(e.select("doc_id", F.size("embedding").alias("dims"), norm.alias("length")))


@query(
    "embed_only_new_ids", "M5", "D4", "H3",
    sql=f"SELECT doc_id, {_DIGEST} FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def _(spark, d):
    done = table(spark, d, "labels").select("doc_id")
    return _flat(V.incremental_embed(table(spark, d, "documents"), done, "doc_id", "text", digest_model))


CENTRES_SQL = """
parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
dims AS (SELECT label, i, avg(x) AS x FROM parts GROUP BY 1, 2),
q AS (SELECT label AS query_id, list(x ORDER BY i) AS v FROM dims GROUP BY 1),
hits AS (SELECT query_id, vec_id AS id, label, list_cosine_similarity(v, embedding::DOUBLE[]) AS score FROM q, embeddings),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM hits)"""


def _centres(spark, d):
    """One query vector per label: the mean of its vectors."""
    parts = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    dims = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    # as many entries per label as the vectors have dimensions
    return dims.groupBy(F.col("label").alias("query_id")).agg(F.transform(ordered, lambda s: s["x"]).alias("embedding"))


def _index(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


@query(
    "vector_top_k", "M6", "G4",
    sql=f"WITH {CENTRES_SQL} SELECT query_id, id, round(score, 6) AS score, rank FROM top WHERE rank <= 10",
)
def _(spark, d):
    return rounded(V.vector_topk(_centres(spark, d), _index(spark, d), 10))


@query(
    "vector_index_recall", "M6",
    sql="SELECT count(*) * 10 AS wanted, true AS recall_reached, true AS scores_exact FROM embeddings WHERE vec_id % 50 = 0",
)
def _(spark, d):
    """Ten neighbours of every fiftieth row by the inverted file, against the exact ones.

    The number of lists to probe is fitted on every second of those queries.
    """
    rows = _index(spark, d).drop("label")
    asked = rows.filter("id % 50 = 0").withColumnRenamed("id", "query_id")
    exact = materialise(V.vector_topk(asked, rows, 10), "exact-hits")
    index = V.vector_index(rows)
    probes = V.probes_for(index, asked.filter("query_id % 100 = 0"), exact.filter("query_id % 100 = 0"))
    found = V.probe_topk(asked, index, 10, probes)
    vectors = lambda name: rows.select(F.col("id").alias(name), F.col("embedding").alias(f"_{name}"))
    check = found.join(vectors("query_id"), "query_id").join(vectors("id"), "id")
    off = F.max(F.abs(F.col("score") - V.cosine(F.col("_query_id"), F.col("_id"))))
    exactness = check.agg((off < 1e-9).alias("scores_exact"))
    reached = V.recall_at(found, exact).select("wanted", (F.col("recall") >= 0.9).alias("recall_reached"))
    return reached.withColumn("scores_exact", exactness.scalar())


@query(
    "vector_index_all_lists", "M6",
    sql=f"WITH {CENTRES_SQL} SELECT query_id, id, round(score, 6) AS score, rank FROM top WHERE rank <= 10",
)
def _(spark, d):
    """With every list probed the inverted file gives the exact neighbours."""
    return rounded(V.probe_topk(_centres(spark, d), V.vector_index(_index(spark, d).drop("label"), lists=12), 10, probes=12))


@query(
    "cosine_to_label_centre", "M6", "I23",
    sql=f"WITH {CENTRES_SQL} SELECT id, query_id AS label, round(score, 6) AS score FROM hits WHERE label = query_id",
)
def _(spark, d):
    centres = _centres(spark, d).select(F.col("query_id").alias("label"), F.col("embedding").alias("centre"))
    both = _index(spark, d).join(centres, "label")
    return rounded(both.select("id", "label", V.cosine(F.col("centre"), F.col("embedding")).alias("score")))


# letters as both engines see them: the texts hold Latin letters only
WORDS_SQL = r"list_filter(string_split_regex(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
BM25_SQL = f"""
docs AS (SELECT doc_id AS id, {WORDS_SQL.format(c='text')} AS w FROM documents),
post AS (SELECT id, len(w) AS n, unnest(w) AS term FROM docs),
tf AS (SELECT id, n, term, count(*) AS tf FROM post GROUP BY 1, 2, 3),
asked AS (SELECT DISTINCT item_id AS query_id, unnest({WORDS_SQL.format(c='text')}) AS term FROM benchmark),
stat AS (SELECT count(*) AS docs, avg(len(w)) AS mean_len FROM docs),
dft AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
bm AS (SELECT query_id, id, sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean_len))) AS score
  FROM asked JOIN tf USING (term) JOIN dft USING (term), stat GROUP BY 1, 2)"""


def _questions(spark, d):
    return table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _texts(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")


@query(
    "keyword_scores", "M7",
    sql=f"""WITH {BM25_SQL} SELECT query_id, id, round(score, 6) AS score,
    row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rank FROM bm QUALIFY rank <= 10""",
)
def _(spark, d):
    return V.keyword_topk(_questions(spark, d), _texts(spark, d), 10)


@query(
    "hybrid_top_k", "M7", "M6",
    sql=f"""WITH {BM25_SQL}, q AS (SELECT item_id, embedding::DOUBLE[] AS v FROM benchmark JOIN embeddings ON vec_id = item_id),
    near AS (SELECT item_id AS query_id, vec_id AS id, list_cosine_similarity(v, embedding::DOUBLE[]) AS score FROM q, embeddings),
    words AS (SELECT query_id, id, round(score, 6) AS score FROM bm),
    lists AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS r FROM near
      UNION ALL SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) FROM words),
    fused AS (SELECT query_id, id, sum(1.0::DOUBLE / (60 + r)) AS score FROM lists WHERE r <= 10 GROUP BY 1, 2)
    SELECT query_id, id, round(score, 9) AS score FROM fused
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) <= 10""",
)
def _(spark, d):
    """Vector and keyword hits of every benchmark item, fused by reciprocal rank."""
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    items = _questions(spark, d)
    asked = items.join(vectors, F.col("query_id") == F.col("id")).select("query_id", "embedding")
    near = V.vector_topk(asked, vectors, 10)
    return rounded(V.hybrid_topk(near, V.keyword_topk(items, _texts(spark, d), 10), 10).drop("rank"), 9)


FUSED_SQL = """
lists AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS r, 0 AS l FROM a0
  UNION ALL SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id), 1 FROM b0),
fused AS (SELECT query_id, id, sum(1.0::DOUBLE / (60 + r)) AS score FROM lists WHERE r <= 10 GROUP BY 1, 2)"""


# two scored "indexes" over the documents: by length and by benchmark words
MERGE_SQL = f"""{BM25_SQL},
a0 AS (SELECT query_id, id, round(score, 6) AS score, 0 AS pos FROM bm),
b0 AS (SELECT query_id, id, round(score / (1 + n), 9) AS score, 1 AS pos FROM bm JOIN (SELECT id, len(w) AS n FROM docs) USING (id)),
u AS (SELECT *, row_number() OVER (PARTITION BY query_id, pos ORDER BY score DESC, id) AS r FROM (FROM a0 UNION ALL FROM b0)),
v AS (SELECT *, score / greatest(max(score) OVER (PARTITION BY query_id, pos), 1.0::DOUBLE) AS norm_score FROM u WHERE r <= 8),
once AS (SELECT v.*, text FROM v JOIN documents ON doc_id = id WHERE text <> ''
  QUALIFY row_number() OVER (PARTITION BY query_id, text ORDER BY pos, r) = 1),
merged AS (SELECT *, CASE pos WHEN 0 THEN 'words' ELSE 'density' END AS source,
  row_number() OVER (PARTITION BY query_id ORDER BY norm_score DESC, pos, r) AS rank FROM once)"""


def _two_lists(spark, d, k):
    """Both lists from one pass over one index."""
    questions = _questions(spark, d)
    index = V.keyword_index(_texts(spark, d), vocabulary=V.query_words(questions))
    found = V.keyword_lists(questions, index, k, lists={"words": (False, 6), "density": (True, 9)}).drop("rank")
    found = materialise(found, "two-lists")
    return tuple(found.filter(F.col("list") == name).drop("list") for name in ("words", "density"))


def _merged(spark, d):
    scored, density = _two_lists(spark, d, 8)
    return V.merge_indexes({"words": scored, "density": density}, texts=_texts(spark, d))


@query(
    "reciprocal_rank_fusion", "M7",
    sql=f"""WITH {MERGE_SQL}, {FUSED_SQL} SELECT query_id, id, round(score, 9) AS score FROM fused
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) <= 10""",
)
def _(spark, d):
    scored, density = _two_lists(spark, d, 10)
    return rounded(V.hybrid_topk(scored, density, 10).drop("rank"), 9)


@query(
    "merge_index_hits", "M8", "F10", "H1", "H2", "G4",
    sql=f"WITH {MERGE_SQL} SELECT query_id, id, source, round(norm_score, 6) AS norm_score, rank FROM merged WHERE rank <= 10",
)
def _(spark, d):
    return rounded(_merged(spark, d).select("query_id", "id", "source", "norm_score", "rank"))


@query(
    "answer_context", "M9",
    sql=f"""WITH {MERGE_SQL} SELECT query_id, string_agg(chr(10) || '[' || rank::VARCHAR || '] Source: ' || source || chr(10) || text || chr(10),
    chr(10) ORDER BY rank) AS context FROM merged WHERE rank <= 10 GROUP BY 1""",
)
def _(spark, d):
    return V.build_context(_merged(spark, d))


@query(
    "extract_page_links", "M10", "C17",
    sql=r"""WITH c AS (SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS c,
      generate_subscripts(regexp_extract_all(html, '<li>(.*?)</li>', 1), 1) - 1 AS item FROM pages)
    SELECT page_id, item, trim(regexp_extract(c, 'href="([^"]*)"', 1)) AS link, trim(regexp_extract(c, '>([^<]*)</a>', 1)) AS title FROM c
    WHERE trim(regexp_extract(c, 'href="([^"]*)"', 1)) <> '' AND trim(regexp_extract(c, '>([^<]*)</a>', 1)) <> ''""",
)
def _(spark, d):
    rules = {"link": 'href="([^"]*)"', "title": ">([^<]*)</a>"}
    return MK.extract_fields(table(spark, d, "pages"), "html", "<li>(.*?)</li>", rules, keep=("page_id",))


@query(
    "clean_page_text", "M11", "I5",
    sql=r"""SELECT page_id, replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<!DOCTYPE[^>]*>', '', 'g'),
      '(?i)<script[^>]*>.*?</script>', '', 'g'), '(?i)<style[^>]*>.*?</style>', '', 'g'), '<[^>]+>', '', 'g'),
      '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>') AS plain FROM pages""",
)
def _(spark, d):
    return table(spark, d, "pages").select("page_id", strip_markup(F.col("html")).alias("plain"))


@query(
    "headline_ticker_filter", "M12", "C13",
    sql="""WITH t AS (SELECT DISTINCT string_split(p_name, ' ')[2] AS ticker FROM part)
    SELECT p_partkey, p_name AS title, ticker FROM part JOIN t ON contains(p_name, ticker)""",
)
def _(spark, d):
    parts = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("title"))
    tickers = parts.select(F.try_element_at(F.split("title", " "), F.lit(2)).alias("ticker")).distinct()
    return V.headline_filter(parts, tickers)


@query(
    "flatten_news_feed", "M13", "D7", "I22", "I23",
    sql="""SELECT conv_id, turn, role AS entry_by_role, unnest(string_split(text, chr(10))) AS entry_line FROM conversations""",
)
def _(spark, d):
    """Articles with a list of nested entries, flattened to one row per entry."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda l: F.struct(F.struct(F.struct(F.col("role")).alias("by"), l.alias("line")).alias("entry")),
    )
    feed = table(spark, d, "conversations").select("conv_id", "turn", lines.alias("ticker_sentiment"))
    return MK.flatten_news(feed)
