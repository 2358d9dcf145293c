"""Registered queries on documents, embeddings, search and prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attriflux.catalog.core import register
from attriflux.catalog.inputs import CTES, once, r, sales_features, sql, table
from attriflux.functions.columns import half_even, rounded
from attriflux.operators import documents as do
from attriflux.operators import retrieval as re_
from attriflux.operators import vector_index
from attriflux.operators.dense_encoder import DenseEncoder
from attriflux.session import fresh_path

_fix = lambda e, d=2, sign="": f"coalesce(printf('%{sign}.{d}f', {r(e, d)}), 'nan')"
_wow = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '' ELSE '{label} change week-over-week: ' || {_fix(c + ' * 100', 1, '+')} || '%.' || chr(10) END"
    for c, label in (("roas_wow", "ROAS"), ("ctr_wow", "CTR"), ("spend_wow", "Spend")))
CTES["docs"] = (("features",), f"""
SELECT concat_ws('|', 'row', source, campaign_name, CAST(c_date AS VARCHAR)) AS id, campaign_name, category, is_anomaly, c_date,
  'Campaign ' || campaign_name || ' (' || category || ') on ' || CAST(c_date AS VARCHAR) || ':' || chr(10) ||
  'Impressions: ' || impressions || ', Clicks: ' || clicks || ', Leads: ' || leads || ', Orders: ' || orders || '.' || chr(10) ||
  'Spent: $' || {_fix('mark_spent')} || ', Revenue: $' || {_fix('revenue')} || '.' || chr(10) ||
  'CTR: ' || {_fix('ctr * 100')} || '%, CPC: $' || {_fix('cpc')} || ', ROAS: ' || {_fix('roas')} || ', CPL: $' || {_fix('cpl')} || '.' || chr(10) ||
  'Conversion rate: ' || {_fix('conversion_rate * 100')} || '%.' || chr(10) || {_wow} ||
  CASE WHEN is_anomaly = 1 THEN 'This campaign is flagged as an ANOMALY.' ELSE 'This campaign is performing normally.' END AS text
FROM features""")


def _slots(source: str, key: str, text: str) -> str:
    return f"""SELECT {key}, slot, CAST(count(*) AS DOUBLE) AS tf FROM (
  SELECT {key}, ('0x' || substr(md5(word), 1, 8))::BIGINT % {re_.DIMENSIONS} AS slot
  FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[a-z0-9]+')) AS word FROM {source})) GROUP BY 1, 2"""


_questions = ", ".join(f"({i}, '{q}')" for i, q in enumerate(re_.QUESTIONS))
CTES["questions"] = ((), f"SELECT * FROM (VALUES {_questions}) AS v(query_id, question)")
CTES["docslots"] = (("docs",), _slots("docs", "id", "text"))
CTES["weights"] = (("docslots",), """
SELECT slot, ln(((SELECT count(*) FROM docs) + 1::DOUBLE) / (count(*) + 1::DOUBLE)) AS idf FROM docslots GROUP BY slot""")
CTES["docvectors"] = (("weights",), """
SELECT id, slot, w / CASE WHEN norm = 0 THEN 1 ELSE norm END AS w FROM (
  SELECT id, slot, tf * idf AS w, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY id)) AS norm
  FROM docslots JOIN weights USING (slot))""")
CTES["questionslots"] = (("questions",), _slots("questions", "query_id", "question"))
CTES["questionvectors"] = (("questionslots", "weights"), """
SELECT query_id, slot, w / CASE WHEN norm = 0 THEN 1 ELSE norm END AS w FROM (
  SELECT query_id, slot, tf * coalesce(idf, ln((SELECT count(*) FROM docs) + 1::DOUBLE)) AS w,
    sqrt(sum((tf * coalesce(idf, ln((SELECT count(*) FROM docs) + 1::DOUBLE))) ** 2) OVER (PARTITION BY query_id)) AS norm
  FROM questionslots LEFT JOIN weights USING (slot))""")
CTES["hits"] = (("docvectors", "questionvectors"), """
SELECT * FROM (SELECT query_id, id AS doc_id, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank
  FROM (SELECT q.query_id, d.id, round_even((q.sq + d.sq - 2 * coalesce(dot, 0)) * 1e9::DOUBLE, 0) / 1e9::DOUBLE AS distance
    FROM (SELECT query_id, sum(w * w) AS sq FROM questionvectors GROUP BY 1) q
    CROSS JOIN (SELECT id, sum(w * w) AS sq FROM docvectors GROUP BY 1) d
    LEFT JOIN (SELECT query_id, id, sum(a.w * b.w) AS dot FROM questionvectors a JOIN docvectors b USING (slot) GROUP BY 1, 2) x
      ON x.query_id = q.query_id AND x.id = d.id)) WHERE rank <= 3""")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return do.create_documents(sales_features(spark, folder))


@register("row_to_document", sql("SELECT id, text FROM docs", "docs"))
def row_to_document(spark, folder):
    return documents(spark, folder).select("id", "text")


@register("create_documents", sql(
    "SELECT id, text, campaign_name, category, is_anomaly, CAST(c_date AS VARCHAR) AS c_date FROM docs", "docs"))
def create_documents(spark, folder):
    return documents(spark, folder).select("id", "text", "metadata.*")


@register("embed_documents", sql(f"""SELECT id, count(*) FILTER (WHERE w <> 0) AS used_slots, {r('sum(w)')} AS total, {r('max(w)')} AS largest,
  {r('sum(w * slot)', 4)} AS moment FROM docvectors GROUP BY id""", "docvectors"))
def embed_documents(spark, folder):
    """Each document's vector told by four figures; the last depends on the order of its entries."""
    df = re_.embed_documents(documents(spark, folder))
    add = lambda a, b: a + b
    return df.select(
        "id", F.size(F.filter("vec", lambda v: v != 0)).cast("bigint").alias("used_slots"),
        half_even(F.aggregate("vec", F.lit(0.0), add), 6).alias("total"),
        half_even(F.array_max("vec"), 6).alias("largest"),
        half_even(F.aggregate(F.transform("vec", lambda v, i: v * i), F.lit(0.0), add), 4).alias("moment"))


@register("embed_dense")
def embed_dense(spark, folder):
    """Each document's dense vector told by three figures."""
    docs = documents(spark, folder)
    encoder = once(spark, folder, "dense-encoder", lambda: DenseEncoder.fit(docs))
    df = encoder.embed(docs)
    add = lambda a, b: a + b
    return df.select("id", F.size("vec").alias("dimensions"),
                     half_even(F.aggregate(F.transform("vec", lambda v: v * v), F.lit(0.0), add), 6).alias("squares"),
                     half_even(F.abs(F.col("vec")[0]), 4).alias("first"))


@register("create_index", sql("""SELECT d.id, campaign_name, category, is_anomaly, CAST(c_date AS VARCHAR) AS c_date, 384 AS dimensions
FROM docs d""", "docs"))
def create_index(spark, folder):
    path = re_.create_index(sales_features(spark, folder), fresh_path(spark, "index"))
    index, _ = re_.load_index(spark, path)
    return index.select("id", "metadata.*", F.size("vec").alias("dimensions"))


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")


def _centres(items: DataFrame) -> DataFrame:
    """One query per label: the mean of its vectors."""
    size = 64   # length of the given embeddings
    mean = F.array(*[F.avg(F.col("vec")[i]) for i in range(size)])
    return items.groupBy(F.col("label").alias("query_id")).agg(mean.alias("vec"))


def _nearest_sql(condition: str) -> str:
    return sql(f"""SELECT query_id, doc_id, {r('distance')} AS distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM (
    SELECT q.label AS query_id, vec_id AS doc_id, round_even(sum((x - c) * (x - c)) * 1e9::DOUBLE, 0) / 1e9::DOUBLE AS distance
    FROM (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS c FROM (
        SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2) q
    JOIN (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) d
      ON q.pos = d.pos WHERE {condition} GROUP BY 1, 2)) WHERE rank <= 5""")


def _shown(hits: DataFrame) -> DataFrame:
    return rounded(hits.select("query_id", "doc_id", "distance", F.col("rank").cast("bigint").alias("rank")))


@register("query_topk", _nearest_sql("true"))
def query_topk(spark, folder):
    items = _items(spark, folder)
    return _shown(re_.query_topk(items, _centres(items), 5))


@register("query_topk_blocks", _nearest_sql("true"))
def query_topk_blocks(spark, folder):
    """Blocks of three queries: several blocks of queries meet each block of documents."""
    items = _items(spark, folder)
    return _shown(re_.query_topk(items, _centres(items), 5, block=3))


@register("query_topk_many", sql(f"""SELECT query_id, doc_id, {r('distance')} AS distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM (
    SELECT q.vec_id AS query_id, d.vec_id AS doc_id,
      round_even(list_distance(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])) ** 2 * 1e9::DOUBLE, 0) / 1e9::DOUBLE AS distance
    FROM embeddings q CROSS JOIN embeddings d)) WHERE rank <= 3"""))
def query_topk_many(spark, folder):
    """Every row is a query: as many queries as documents, in one plan."""
    items = _items(spark, folder)
    return _shown(re_.query_topk(items, items.select(F.col("id").alias("query_id"), "vec"), 3))


def vector_index_path(spark: SparkSession, folder: str) -> str:
    make = lambda: vector_index.write_index(_items(spark, folder), fresh_path(spark, "vector-index"), buckets=32)
    return once(spark, folder, "vector-index", make)


@register("search_index", _nearest_sql("true"))
def search_index(spark, folder):
    """The bucketed index: only buckets that may hold a hit are read, and the answer is that of the whole table."""
    hits, _ = vector_index.search_index(spark, vector_index_path(spark, folder), _centres(_items(spark, folder)), 5)
    return _shown(hits)


@register("search_index_filtered", _nearest_sql("d.label >= 5"))
def search_index_filtered(spark, folder):
    items = _items(spark, folder)
    hits, _ = vector_index.search_index(spark, vector_index_path(spark, folder), _centres(items), 5, F.col("label") >= 5)
    return _shown(hits)


@register("query_topk_filtered", _nearest_sql("d.label >= 5"))
def query_topk_filtered(spark, folder):
    items = _items(spark, folder)
    return _shown(re_.query_topk_filtered(items, _centres(items), F.col("label") >= 5, 5))


def index_path(spark: SparkSession, folder: str) -> str:
    return once(spark, folder, "index", lambda: re_.create_index(sales_features(spark, folder), fresh_path(spark, "index")))


def _index(spark: SparkSession, folder: str) -> tuple[DataFrame, re_.TextEncoder]:
    return re_.load_index(spark, index_path(spark, folder))


def _retrieved(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    docs, encoder = _index(spark, folder)
    questions = re_.question_frame(spark)
    hits, _ = vector_index.search_index(spark, index_path(spark, folder), encoder.embed(questions, "question"), 3)
    return re_.with_documents(hits, docs), questions


@register("batch_questions", sql(f"""SELECT query_id, rank, doc_id, {r('distance', 4)} AS distance, split_part(text, chr(10), 1) AS first_line
FROM hits JOIN docs ON doc_id = id""", "hits", "docs"))
def batch_questions(spark, folder):
    docs, encoder = _index(spark, folder)
    out = re_.batch_questions(docs, encoder, re_.question_frame(spark), 3)
    return rounded(out.withColumn("rank", F.col("rank").cast("bigint")), 4)


_escape = lambda text: "'" + text.replace("'", "''") + "'"


@register("build_prompt", sql(f"""SELECT query_id, {_escape(do.SYSTEM_PROMPT)} AS system_message,
  {_escape(do.CONTEXT_HEAD)} || string_agg(text, {_escape(do.CONTEXT_SEPARATOR)} ORDER BY rank) || {_escape(do.QUESTION_HEAD)} || min(question) AS user_message
FROM hits JOIN docs ON doc_id = id JOIN questions USING (query_id) GROUP BY query_id""", "hits", "docs", "questions"))
def build_prompt(spark, folder):
    hits, questions = _retrieved(spark, folder)
    out = do.build_prompt(hits, questions)
    return out.select("query_id", F.col("messages")[0]["content"].alias("system_message"),
                      F.col("messages")[1]["content"].alias("user_message"))


@register("answer_sources", sql("""SELECT query_id, count(*) AS sources_count, string_agg(campaign_name, ',' ORDER BY rank) AS source_campaigns,
  string_agg(DISTINCT campaign_name, ',' ORDER BY campaign_name) AS distinct_campaigns
FROM hits JOIN docs ON doc_id = id GROUP BY query_id""", "hits", "docs"))
def answer_sources(spark, folder):
    hits, _ = _retrieved(spark, folder)
    out = do.answer_sources(hits)
    return out.select("query_id", "sources_count", F.array_join("source_campaigns", ",").alias("source_campaigns"),
                      F.array_join("distinct_campaigns", ",").alias("distinct_campaigns"))
