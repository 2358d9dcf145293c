"""A corpus pipeline of five stages: quality, near-duplicates, personal data, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last
return the columns of documents. An empty table stays empty in every stage,
null ids and columns with other names pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from attriflux.llm.line_quality import keep_content, train_line_model
from attriflux.llm.mixing import mixed_rows
from attriflux.llm.packing import pack_documents
from attriflux.llm.pii import mask_personal_data
from attriflux.llm.shared import read, stored
from attriflux.llm.simhash import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the line CRF rejects go. The CRF is fitted on the labelled documents.

    Null and empty texts fail the base rule. Repeated rows share their verdict. No labels: every line is content.
    """
    return keep_content(docs, train_line_model(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the SimHash operator stays, with three words and three bits as in its contract.

    The smallest doc_id stays; a null id only if the component has no other. Equal rows are copies. Null texts and texts without words are one component.
    """
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kinds. No document goes. Null texts stay null; equal rows are masked alike."""
    return mask_personal_data(docs, length_column="n_chars" if "n_chars" in docs.columns else None)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources reach their targets. Texts without words go; equal rows share their draws."""
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of all documents are placed into training sequences. A document without words gets a row without a sequence."""
    return pack_documents(docs)


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("personal data", personal_data),
          ("mixing", mixing), ("packing", packing)]

#: Fitted models, connected components and balanced draws have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
