"""Feature rows as retrievable text documents, and prompts built from retrieved ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attriflux.functions.columns import fixed

# Prompt texts.
SYSTEM_PROMPT = """You are an expert ad campaign analyst AI assistant.
You analyze marketing campaign performance data and provide actionable insights.

Rules:
- Base your answers ONLY on the provided campaign data below.
- Always include specific numbers (ROAS, CTR, CPC, etc.) from the data.
- If the data doesn't contain enough information to answer, say so honestly.
- Keep answers concise but insightful (3-5 sentences).
- When comparing campaigns, use concrete metrics.
- If a campaign is flagged as an ANOMALY, explain what might be wrong.
"""
CONTEXT_HEAD = "Here is the relevant campaign data:\n\n"
CONTEXT_SEPARATOR = "\n\n---\n\n"
QUESTION_HEAD = "\n\nBased on the data above, answer this question:\n"


def _text(name: str, columns: list[str]) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("nan")) if name in columns else F.lit("unknown")


def row_to_document(columns: list[str]) -> Column:
    """The text of a feature row. Sections whose columns the table lacks are left out."""
    col = F.col
    lines = [F.concat(
        F.lit("Campaign "), _text("campaign_name", columns), F.lit(" ("), _text("category", columns),
        F.lit(") on "), _text("c_date", columns), F.lit(":"))]
    if "impressions" in columns:
        lines.append(F.format_string(
            "Impressions: %d, Clicks: %d, Leads: %d, Orders: %d.",
            *[col(c).cast("bigint") for c in ("impressions", "clicks", "leads", "orders")]))
    if "mark_spent" in columns:
        lines.append(F.concat(
            F.lit("Spent: $"), fixed(col("mark_spent"), 2), F.lit(", Revenue: $"), fixed(col("revenue"), 2), F.lit(".")))
    if "ctr" in columns:
        lines.append(F.concat(
            F.lit("CTR: "), fixed(col("ctr") * 100, 2), F.lit("%, CPC: $"), fixed(col("cpc"), 2),
            F.lit(", ROAS: "), fixed(col("roas"), 2), F.lit(", CPL: $"), fixed(col("cpl"), 2), F.lit(".")))
    if "conversion_rate" in columns:
        lines.append(F.concat(F.lit("Conversion rate: "), fixed(col("conversion_rate") * 100, 2), F.lit("%.")))
    for name, label in (("roas_wow", "ROAS"), ("ctr_wow", "CTR"), ("spend_wow", "Spend")):
        if name in columns:
            # missing changes give a null line, which concat_ws leaves out
            lines.append(F.when(col(name).isNotNull(), F.concat(
                F.lit(f"{label} change week-over-week: "), fixed(col(name) * 100, 1, signed=True), F.lit("%."))))
    if "is_anomaly" in columns:
        lines.append(F.when(col("is_anomaly") == 1, "This campaign is flagged as an ANOMALY.")
                     .otherwise("This campaign is performing normally."))
    return F.concat_ws("\n", *lines)


def create_documents(df: DataFrame) -> DataFrame:
    """(id, text, metadata). The id is made from the business key, so it does not depend on row order.

    Facts without an id of their own may share their key. The second and later
    ones, in order of all their values, get their number behind it.
    """
    columns = df.columns
    parts = [c for c in ("source", "campaign_name", "c_date", "id") if c in columns]
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in columns else F.lit("")
    metadata = [plain("campaign_name").alias("campaign_name"), plain("category").alias("category"),
                (F.coalesce(F.col("is_anomaly").cast("int"), F.lit(0)) if "is_anomaly" in columns
                 else F.lit(0)).alias("is_anomaly")]
    if "c_date" in columns:
        metadata.append(plain("c_date").alias("c_date"))
    name = F.concat_ws("|", F.lit("row"), *[plain(c) for c in parts])
    if "id" not in columns:
        same = Window.partitionBy(*parts).orderBy(*columns) if parts else Window.partitionBy(*columns).orderBy(*columns)
        df = df.withColumn("_nth", F.row_number().over(same))
        name = F.concat_ws("|", name, F.when(F.col("_nth") > 1, F.col("_nth").cast("string")))
    return df.select(
        name.alias("id"),
        row_to_document(columns).alias("text"),
        F.struct(*metadata).alias("metadata"))


def build_prompt(hits: DataFrame, questions: DataFrame) -> DataFrame:
    """(query_id, question, messages) from retrieved documents (query_id, rank, text).

    A question's context is the retrieval's top k, so the collected list is short.
    """
    context = hits.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("docs"))
    joined = questions.join(context, "query_id", "left")
    texts = F.transform(F.coalesce(F.col("docs"), F.array()), lambda d: d["text"])
    user = F.concat(F.lit(CONTEXT_HEAD), F.array_join(texts, CONTEXT_SEPARATOR),
                    F.lit(QUESTION_HEAD), F.col("question"))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return joined.select(
        "query_id", "question",
        F.array(message("system", F.lit(SYSTEM_PROMPT)), message("user", user)).alias("messages"))


def answer_sources(hits: DataFrame, questions: DataFrame | None = None) -> DataFrame:
    """Per question: number of sources, their campaigns in rank order, and the distinct campaigns.

    With ``questions`` (query_id), those without hits have a row too, with no sources.
    """
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col("metadata.campaign_name").alias("name"))))
    out = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("sources_count"), ordered.alias("ordered"))
    if questions is not None:
        out = questions.select("query_id").join(out, "query_id", "left")
    names = F.transform(F.coalesce("ordered", F.array()), lambda s: s["name"])
    return out.select(
        "query_id", F.coalesce("sources_count", F.lit(0).cast("bigint")).alias("sources_count"), names.alias("source_campaigns"),
        F.array_sort(F.array_distinct(names)).alias("distinct_campaigns"))
