"""Raw payloads: landing them once, hashing them, and unpacking their rows."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import strip
from .work import WorkTables

KEY = ["run_id", "source", "request_key"]
#: Folders of the landed table, so that a choice of runs is a choice of folders.
FOLDERS = ["source", "target_date", "run_id"]
#: Folders and overruled requests of them that are sent to every task at most; more are joined by shuffle.
MOST_KEYS = 500_000
#: Bytes of payloads that a worker hashes at once; a longer payload comes alone. This changes memory only.
HASHED_BYTES = 4 << 20
#: Request parameters that are never kept (fixed values).
SECRETS = ("token", "api_key")


@F.pandas_udf(T.StringType())
def canonical_json(payload: pd.Series) -> pd.Series:
    """Key-sorted JSON with the usual separators ", " and ": "; text that is no JSON becomes a JSON string, as it was sent."""
    def one(x):
        try:
            value = json.loads(x)
        except (TypeError, ValueError):
            value = x
        return json.dumps(value, sort_keys=True, ensure_ascii=False)

    return payload.map(one, na_action="ignore")


def payload_hash(payload: Column) -> Column:
    """SHA-256 of the key-sorted JSON; null for a null payload."""
    return F.sha2(canonical_json(payload).cast("binary"), 256)


def new_snapshots(payloads: DataFrame, landed: DataFrame) -> DataFrame:
    """Payloads whose (run_id, source, request_key) has not landed, with their hash and without secret parameters.

    Of several rows of one key in the batch, that with the smallest payload hash lands. Rows with a null in the key never equal
    a landed one and land each time.
    """
    p = payloads.join(landed.select(*KEY), KEY, "left_anti")
    p = p.withColumns({"parameters": F.map_filter("parameters", lambda k, _: ~F.lower(k).isin(*SECRETS)), "payload_hash": payload_hash(F.col("payload"))})
    w = Window.partitionBy(*KEY).orderBy(F.col("payload_hash").asc_nulls_last(), F.to_json("parameters"))
    known = F.col("run_id").isNotNull() & F.col("source").isNotNull() & F.col("request_key").isNotNull()
    return p.withColumn("__n", F.row_number().over(w)).where((F.col("__n") == 1) | ~known).drop("__n")


def append_snapshots(payloads: DataFrame, path: str) -> None:
    """Append payloads that have not landed to the table at ``path``; a rerun adds nothing.

    Workers get payloads in batches of HASHED_BYTES (a setting of the session, restored afterwards), as they hold a batch several times over.
    """
    spark = payloads.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)
    keys = spark.read.parquet(path) if exists else payloads.limit(0)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(HASHED_BYTES))
    try:
        new_snapshots(payloads, keys).write.mode("append").partitionBy(*FOLDERS).parquet(path)
    finally:
        spark.conf.set(name, before)


def chosen_requests(landed: DataFrame, runs: DataFrame, as_of: Column | None = None) -> DataFrame:
    """source, target_date, request_key, run_id, finished_at: for each request the latest run that holds it and finished well.

    ``runs`` has run_id, finished_at and status; runs that are still at work or did not end in SUCCESS never count, nor, with ``as_of``, those that
    finished after it. Of runs that finished together the greater run_id is later. A request without a key is one of an empty key. Of ``landed``
    only the folders and the key are read.
    """
    done = (F.col("status") == "SUCCESS") & F.col("finished_at").isNotNull()
    if as_of is not None:
        done = done & (F.col("finished_at") <= as_of)
    keys = landed.select(*FOLDERS, F.coalesce("request_key", F.lit("")).alias("request_key"))
    last = F.max(F.struct("finished_at", "run_id")).alias("r")
    found = keys.join(runs.where(done).select("run_id", "finished_at"), "run_id").groupBy("source", "target_date", "request_key").agg(last)
    return found.select("source", "target_date", "request_key", "r.run_id", "r.finished_at")


def current_payloads(landed: DataFrame, runs: DataFrame, work: WorkTables, as_of: Column | None = None, most_keys: int = MOST_KEYS) -> DataFrame:
    """Rows of ``landed`` that ``chosen_requests`` chooses, with ``landed``: a struct that orders payloads by the end of their run.

    The choice is made on keys and comes down to folders: those of which nothing is chosen are never read, and of those that a later run
    overrules in part the overruled keys are listed. While folders and listed keys are at most ``most_keys`` they are sent to every task, so that
    payloads are filtered where they lie and never shuffled; beyond that they are joined by shuffle. A request that one run landed
    twice stays twice.
    """
    chosen = work.write(chosen_requests(landed, runs, as_of), "chosen")
    keys = landed.select(*FOLDERS, F.coalesce("request_key", F.lit("")).alias("request_key")).distinct()
    there = keys.groupBy(*FOLDERS).agg(F.count(F.lit(1)).alias("n"))
    kept = chosen.groupBy(*FOLDERS).agg(F.count(F.lit(1)).alias("n_kept"), F.first("finished_at").alias("finished_at"))
    folders = kept.join(there, FOLDERS)
    partly = folders.where("n_kept < n").select(*FOLDERS)
    lost = keys.join(partly, FOLDERS, "left_semi").join(chosen, [*FOLDERS, "request_key"], "left_anti").groupBy(*FOLDERS).agg(F.collect_list("request_key").alias("lost"))
    folders = work.write(folders.join(lost, FOLDERS, "left").select(*FOLDERS, "finished_at", "n_kept", "lost"), "folders")
    n = folders.agg(F.sum(1 + F.coalesce(F.array_size("lost"), F.lit(0)))).first()[0] or 0
    key = F.coalesce("request_key", F.lit(""))
    if n <= most_keys:
        # a comparison on the small side lets Spark prune folders while it reads
        out = landed.join(F.broadcast(folders.where("n_kept > 0")), FOLDERS).where(~F.coalesce(F.array_contains("lost", key), F.lit(False))).drop("lost", "n_kept")
    else:
        out = landed.withColumn("request_key", key).join(chosen.hint("merge"), [*FOLDERS, "request_key"])
    return out.withColumn("landed", F.struct("finished_at", "target_date", "run_id", key.alias("request_key"))).drop("finished_at")


def write_by_date(df: DataFrame, path: str, keys: tuple[str, ...] = ("strategy_version", "trading_date"), unique: tuple[str, ...] = ("stock_id",), order: Column | None = None) -> None:
    """Replace the partitions that ``df`` holds and no others; one row for each (keys, unique) is written, the last in ``order``.

    Without an order the row that compares greatest as a whole is taken, so that reruns agree.
    """
    plain = [c for c, t in df.dtypes if not t.startswith("map")]
    w = Window.partitionBy(*keys, *unique).orderBy((F.struct(*plain) if order is None else order).desc())
    one = df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    one.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def is_json_array(payload: Column) -> Column:
    """Whether a payload is a JSON array; null: false. A source that should send one and does not has failed."""
    return F.coalesce(F.ltrim(payload).startswith("[") & F.from_json(payload, "array<string>").isNotNull(), F.lit(False))


def json_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per object of a bare JSON array: columns of ``df``, ordinal, fields (map of strings). No array: no rows (see ``is_json_array``)."""
    items = F.from_json(F.col(payload), "array<string>")
    d = df.select("*", F.posexplode(items).alias("ordinal", "item"))
    return d.withColumn("fields", F.from_json("item", "map<string,string>")).where(F.col("item").startswith("{") & F.col("fields").isNotNull()).drop("item")


def envelope_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """As ``json_rows`` for objects under ``data``; any other shape: no rows."""
    return json_rows(df.withColumn("__data", F.get_json_object(payload, "$.data")), "__data").drop("__data")


def csv_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per record of a CSV after its header: columns of ``df``, ordinal, fields (map of strings by the payload's own header).

    Cells may be quoted and then hold commas, doubled quotes and line breaks. Cells beyond the header are left out, absent ones
    are null, and of a name that occurs twice the last column counts. Empty lines and a byte-order mark are skipped.
    """
    cells = F.lit(r',((?:"[^"]*+")++|[^,]*+)')

    def split(record: Column) -> Column:
        raw = F.regexp_extract_all(F.concat(F.lit(","), record), cells, F.lit(1))
        return F.transform(raw, lambda x: F.when(x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))

    text = F.regexp_replace(F.col(payload), "\\A\ufeff", "")
    records = F.filter(F.regexp_extract_all(text, F.lit(r'(?:[^"\r\n]++|"[^"]*+")++'), F.lit(0)), lambda x: F.trim(x) != "")
    d = df.withColumn("__records", records).withColumn("__head", split(F.get("__records", F.lit(0))))
    d = d.select("*", F.posexplode(F.slice("__records", 2, F.greatest(F.size("__records") - 1, F.lit(0)))).alias("ordinal", "__record"))
    d = d.withColumn("__cells", split(F.col("__record")))
    head, n = F.col("__head"), F.size("__head")
    pairs = F.transform(head, lambda name, i: F.struct(name.alias("k"), F.get("__cells", i).alias("v")))
    last = F.filter(pairs, lambda p, i: n - F.array_position(F.reverse(head), p["k"]) == i)
    return d.withColumn("fields", F.map_from_entries(last)).drop("__records", "__head", "__record", "__cells")


def history_slice(rows: DataFrame, ids: DataFrame, start, end, by: str = "trading_date") -> DataFrame:
    """Rows of the given stocks with ``start`` <= date <= ``end``; blank ids are no stocks."""
    if start > end:
        raise ValueError("start is after end")
    named = ids.where(strip(F.col("stock_id")) != "").select("stock_id").distinct()
    return rows.where(F.col(by).between(F.lit(start), F.lit(end))).join(named, "stock_id", "left_semi")


def history_ranges(targets: DataFrame, days: int) -> DataFrame:
    """stock_id, first, last: the days that lie at most ``days`` before a target (stock_id, trading_date), as ranges that do not meet.

    Ranges of a stock that overlap or follow on each other are one. A target without an id stops the job when its row is read.
    """
    if days < 1:
        raise ValueError("a history has one day at least")
    sid = F.when(F.coalesce(strip(F.col("stock_id")), F.lit("")) == "", F.raise_error(F.lit("a target has no stock_id"))).otherwise(F.col("stock_id"))
    w = Window.partitionBy("stock_id").orderBy("trading_date")
    d = targets.where(F.col("trading_date").isNotNull()).select(sid.alias("stock_id"), "trading_date").distinct()
    # all ranges are of one length, so they meet where targets are no further apart than that
    apart = F.coalesce(F.datediff("trading_date", F.lag("trading_date").over(w)) > days, F.lit(False))
    d = d.withColumn("part", F.sum(apart.cast("int")).over(w))
    return d.groupBy("stock_id", "part").agg(F.date_sub(F.min("trading_date"), days).alias("first"), F.date_sub(F.max("trading_date"), 1).alias("last")).drop("part")


def history_panel(rows: DataFrame, targets: DataFrame, days: int, by: str = "trading_date", month: str | None = None) -> DataFrame:
    """Rows of ``rows`` (stock_id and the date ``by``) within ``days`` before any target of their stock, each once.

    Ranges are cut by month, so rows and ranges meet on (stock, month) and a long history of one stock is dealt over many tasks. ``month`` names a
    column of ``rows`` that holds the first day of each row's month; if the table is laid out by it, months without a target's history are not read.
    """
    ranges = history_ranges(targets, days)
    months = F.sequence(F.trunc("first", "MM"), F.trunc("last", "MM"), F.expr("interval 1 month"))
    cut = ranges.select(F.col("stock_id").alias("__id"), "first", "last", F.explode(months).alias("__month"))
    at = F.col(month) if month else F.trunc(by, "MM")
    return rows.join(cut, (F.col("stock_id") == F.col("__id")) & (at == F.col("__month")) & F.col(by).between(F.col("first"), F.col("last")), "left_semi")
