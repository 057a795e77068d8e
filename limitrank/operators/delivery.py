"""Once-only delivery: an append-only ledger of reservations and outcomes, folded to the state of each key.

A message is reserved before it is sent. A rerun, or a second run beside the first, finds the reservation and sends nothing twice; the same key with
another text is a conflict and never goes out. Nothing is updated in place: what happened is a row, and the state is what the rows amount to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the ledger. kind: RESERVED, SUCCESS or FAILED; seq orders the rows of a key, as ``at`` may be equal.
LEDGER = "key string, hash string, kind string, at timestamp, seq long, request_id string, error string"


def delivery_key(day: Column, version: Column, target: Column, message_version: Column) -> Column:
    return F.sha2(F.concat_ws("|", day.cast("string"), version, F.sha2(target, 256), message_version), 256)


def retry_key(key: Column) -> Column:
    """The name under which a message is sent each time, in the form of a UUID; the key decides it, so a rerun that lost the answer uses it again."""
    h = F.md5(F.concat(F.lit("retry|"), key))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def ledger_state(ledger: DataFrame) -> DataFrame:
    """key, hash, status, attempts, since, sent_at, request_id, error of each reserved key of a ledger.

    The first reservation gives the hash. Outcomes count from then on, in the order of (at, seq): status is SUCCESS from the first success, whatever
    comes later, else FAILED if one failed, else PENDING; attempts counts the failures before the success; error is that of the last failure, null
    after a success. Rows of a key that was never reserved, and rows without a key, are left out. Rows that occur twice count once.
    """
    at = F.struct("at", "seq")
    rows = ledger.where(F.col("key").isNotNull()).dropDuplicates(["key", "kind", "at", "seq"]).withColumn("t", at)
    reserved, good, bad = (F.col("kind") == k for k in ("RESERVED", "SUCCESS", "FAILED"))
    first = rows.groupBy("key").agg(
        F.min(F.when(reserved, F.struct("t", "hash"))).alias("r"), F.min(F.when(good, F.struct("t", "request_id"))).alias("s"),
        # failures are few; those after the success are told apart by their times
        F.collect_list(F.when(bad, F.struct("t", "error"))).alias("f"),
    ).where(F.col("r").isNotNull())
    failures = F.array_sort(F.filter("f", lambda x: (x["t"] >= F.col("r.t")) & (F.col("s").isNull() | (x["t"] < F.col("s.t")))))
    d = first.withColumn("f", failures)
    sent = F.col("s").isNotNull() & (F.col("s.t") >= F.col("r.t"))
    return d.select(
        "key", F.col("r.hash").alias("hash"), F.when(sent, "SUCCESS").when(F.size("f") > 0, "FAILED").otherwise("PENDING").alias("status"), F.size("f").alias("attempts"),
        F.col("r.t.at").alias("since"), F.when(sent, F.col("s.t.at")).alias("sent_at"), F.when(sent, F.col("s.request_id")).alias("request_id"),
        F.when(~sent, F.try_element_at("f", F.lit(-1))["error"]).alias("error"),
    )


def publish_once(messages: DataFrame, state: DataFrame) -> DataFrame:
    """messages (key, text, ...) with hash and action against ``state`` (key, hash, status; see ``ledger_state``).

    ``insert``: a new key, to be reserved and sent; ``skip``: sent before with this text; ``retry``: reserved with this text and not sent yet;
    ``conflict``: reserved with another text. Within a batch the same rules hold: of the rows of a new key the one with the least
    ``ordinal`` (where rows have one, else the least hash) reserves it; rows with its text are a ``repeat``, others a conflict, and of rows to
    be retried one is. A null key is no key: ``invalid``.
    """
    m = messages.withColumn("hash", F.sha2("text", 256))
    d = state.select("key", F.col("hash").alias("__h"), F.col("status").alias("__s"))
    order = [F.col("ordinal"), F.col("hash")] if "ordinal" in messages.columns else [F.col("hash")]
    m = m.join(d, "key", "left")
    batch = Window.partitionBy("key").orderBy(*[c.asc_nulls_last() for c in order])
    same = Window.partitionBy("key", "hash").orderBy(*[c.asc_nulls_last() for c in order])
    m = m.withColumns({"__first": F.first("hash").over(batch), "__n": F.row_number().over(same)})
    known, text = F.col("__h").isNotNull(), F.col("hash")
    action = (
        F.when(F.col("key").isNull(), "invalid").when(known & ~text.eqNullSafe(F.col("__h")), "conflict").when(~known & ~text.eqNullSafe(F.col("__first")), "conflict")
        .when(F.col("__s") == "SUCCESS", "skip").when(F.col("__n") > 1, "repeat").when(~known, "insert").otherwise("retry")
    )
    return m.withColumn("action", action).drop("__h", "__s", "__first", "__n")


def reservations(decided: DataFrame, at: Column) -> DataFrame:
    """Ledger rows that reserve what ``publish_once`` inserts; they are written before anything is sent."""
    none = F.lit(None).cast("string")
    return decided.where("action = 'insert'").select("key", "hash", F.lit("RESERVED").alias("kind"), at.cast("timestamp").alias("at"), F.lit(0).cast("long").alias("seq"), none.alias("request_id"), none.alias("error"))


def outcomes(sent: DataFrame, at: Column) -> DataFrame:
    """Ledger rows of what became of messages: ``sent`` has key, attempt, ok, request_id and error."""
    none = F.lit(None).cast("string")
    return sent.select(
        "key", none.alias("hash"), F.when(F.col("ok"), "SUCCESS").otherwise("FAILED").alias("kind"), at.cast("timestamp").alias("at"), F.col("attempt").cast("long").alias("seq"),
        F.when(F.col("ok"), F.col("request_id")).alias("request_id"), F.when(~F.col("ok"), F.col("error")).alias("error"),
    )


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger at ``path``; empty where nothing has been written."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(LEDGER).parquet(path) if exists else spark.createDataFrame([], LEDGER)


def reserve(messages: DataFrame, path: str, at: Column) -> DataFrame:
    """Decide on ``messages`` against the ledger at ``path`` and append the reservations; gives the decisions with their retry keys.

    What is given back is read from the ledger as it was before, so decide once and keep the result (write it) before sending.
    """
    before = ledger_state(read_ledger(messages.sparkSession, path))
    decided = publish_once(messages, before).withColumn("retry_key", retry_key(F.col("key")))
    # decided again from the files there are now would call all of it retries, so the reader's list of files is fixed by this plan
    reservations(decided, at).write.mode("append").parquet(path)
    return decided
