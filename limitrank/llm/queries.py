"""Registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, embed_dedup, hard_negatives, jaccard, langid, mixing, oracles, recompress, resample, url_filter, warc, word_lm
from .common import stored

RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _event_log(rows: DataFrame) -> DataFrame:
    """The log that a service would have kept of ``rows`` (conv_id, turn, role, text), out of order: folding it must give the rows back.

    By its content a row was sent whole; or streamed in three parts; or drafted, edited and streamed on; or drafted, generated anew at once and
    streamed, beside a message that was opened and deleted. Rows without a turn were sent whole. Conversation -1 was also generated anew late, which
    drops a message that was opened meanwhile. Texts are cut, not copied.
    """
    at, text, n = F.col("turn") * 8, F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))
    kind = F.when(F.col("turn").isNull(), 0).when(F.col("conv_id") == -1, 4).otherwise(F.pmod(F.xxhash64("conv_id", "turn", "text"), F.lit(4)))
    third = F.floor(n / 3).cast("int")
    part = lambda i: F.substring(text, i * third + 1, n if i == 2 else third)
    own, other = F.col("id"), -1 - F.col("id")

    def event(step: int, name: str, words: Column, msg: Column = own) -> Column:
        return F.struct((at + step).alias("seq"), msg.alias("msg_id"), F.lit(name).alias("kind"), F.when(F.lit(name == "message"), F.col("role")).alias("role"), words.alias("text"))

    draft, none = F.lit("draft"), F.lit(None).cast("string")
    aside = [event(1, "message", draft, other), event(2, "delta", draft, other)]
    logs = [
        [event(0, "message", text)],
        [event(0, "message", part(0)), event(1, "delta", part(1)), event(2, "delta", part(2))],
        [event(0, "message", draft), event(1, "delta", draft), event(2, "edit", part(0)), event(3, "delta", part(1)), event(4, "delta", part(2))],
        [event(0, "message", draft), event(0, "regenerate", none), event(1, "delta", part(0)), event(2, "delta", part(1)), event(3, "delta", part(2)), *aside, event(3, "delete", none, other)],
        [event(0, "message", draft), *aside, event(4, "regenerate", none), event(5, "delta", part(0)), event(6, "delta", part(1)), event(7, "delta", part(2))],
    ]
    log = F.when(kind == 0, F.array(*logs[0]))
    for i, events in enumerate(logs[1:], 1):
        log = log.when(kind == i, F.array(*events))
    return rows.withColumn("id", F.monotonically_increasing_id()).select("conv_id", F.explode(F.reverse(log)).alias("e")).select("conv_id", "e.*")


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log of conversations, with the contract's conversation -1, folded, formatted and read back from the output."""
    c = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.element_at(F.array(F.lit("user"), F.lit("assistant")), (F.col("id") + 1).cast("int")).alias("role"), F.lit(tricky).alias("text"))
    events, _ = stored(_event_log(c.unionByName(more)), "log")
    out = chat.read_back(chat.format_conversations(events))
    told = F.array_join(F.transform("read", lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return out.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=85)


def revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(warc.page_records(_table(spark, sf_dir, "pages")))
    return found.select(
        "record_id", "canonical", F.unix_seconds("ts").alias("captured_at"), "status", "original_id",
        F.col("headers")["etag"].alias("etag"), F.col("headers")["cache-control"].alias("cache_control"), F.col("headers")["content-type"].alias("content_type"),
    )


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"))


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path()))


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _table(spark, sf_dir, "labels").where("quality = 1")
    return word_lm.cross_entropy_difference(_table(spark, sf_dir, "documents"), good)


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages under RULES; their tables come without redirects, so those of one common spelling per address are derived from the urls."""
    pages = _table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, RULES, url_filter.spelling_redirects(pages)).select("page_id", "host", "path", "rule", "verdict")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(langid.crc_fold(F.col("doc_id")) == 2, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    return langid.classify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with the contract's labels; anchors are those with an id divisible by 50."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = recompress.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_formatting": chat_formatting,
        "op2_embedding_near_dedup": embedding_dedup,
        "op3_ngram_jaccard_join": jaccard_join,
        "op4_warc_revisits": revisits,
        "op5_nearest_neighbours": nearest,
        "op6_source_mixing": mixture,
        "op7_bpe": tokens,
        "op8_lm_scoring": lm_scores,
        "op9_url_filters": url_verdicts,
        "op10_language_id": languages,
        "op11_importance_resampling": resampled,
        "op12_hard_negatives": mined_negatives,
        "op13_substring_dedup": repeated_passages,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_formatting": oracles.CHAT, "op4_warc_revisits": oracles.REVISITS, "op6_source_mixing": oracles.MIXING, "op9_url_filters": oracles.url_verdicts(RULES),
            "op11_importance_resampling": oracles.RESAMPLING, "op12_hard_negatives": oracles.NEGATIVES, "op13_substring_dedup": oracles.REPEATS}
