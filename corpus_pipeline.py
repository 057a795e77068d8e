"""A corpus pipeline: language filter, near-duplicate removal, mixing to source weights, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. No stage is SQL: the first applies a model
learned from the table. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limitrank.llm import bpe, jaccard, langid, mixing
from limitrank.llm.common import stored
from limitrank.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification does not reject; the model is learned from their own labels.

    Texts that are null or have no letter are rejected. Rows are judged one by one, so repeated rows stay or go together; without a labelled
    row nothing is known and all go; no rows give no rows. Columns named as the classifier's results pass through like all others.
    """
    model = langid.fit(docs)
    aside = {c: f"__own_{c}" for c in ("lang_pred", "score", "rejected") if c in docs.columns}
    kept = langid.classify(docs.withColumnsRenamed(aside), model).where(~F.col("rejected"))
    return kept.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five words, 0.8): that with the smallest id, null ids last.

    Rows are compared as rows, each under a key of its own, whatever their ids: of repeated rows one stays, rows of one id with
    different texts stand for themselves, and rows with a null id take part. A row without a word is its own group and stays. No rows give
    no rows, and columns of any name pass through.
    """
    row = "_row"
    while row in docs.columns:
        row = f"_{row}"
    keyed, _ = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = jaccard.near_duplicates(keyed.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", row))
    # the groups grow with the documents, so they are never broadcast
    keep = keyed.select(row, "doc_id").join(groups.hint("merge"), row).groupBy("component_id").agg(first[row].alias(row))
    return keyed.join(keep.select(row).hint("merge"), row, "left_semi").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null texts have no words and are never taken. A null source is a source of its own; rows equal in id and text are taken alike, null ids told
    apart by their texts; no rows give no rows.
    """
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: doc_id, source, n_tokens, ids (packed, 4 bytes each) and digests of the ids and the
    decoded text.

    A null text is an empty one; every row has its result, repeated ones too; no rows give no rows; other columns are left out.
    """
    out = bpe.round_trip(docs.select("doc_id", "source", "text"), tokenizer_path())
    return out.select(
        "doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [("language_id", known_language), ("ngram_jaccard_join", one_of_each_group), ("source_mixing", mixed), ("bpe_tokens", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
