"""Memory of the workers that hash payloads."""

import hashlib
import json

from pyspark.sql import functions as F

from limitrank.sources import landing

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_payloads_are_hashed_in_small_batches(spark, tmp_path, monkeypatch):
    seen, make, before = [], landing.new_snapshots, spark.conf.get(NAME)

    def spied(*a):
        seen.append(int(spark.conf.get(NAME).rstrip("b")))
        return make(*a)

    monkeypatch.setattr(landing, "new_snapshots", spied)
    text = lambda i: json.dumps({"b": i, "a": "x" * 300_000})
    rows = [("r", "s", str(i), "2024-01-02", text(i), {"token": "x"}) for i in range(40)]
    landing.append_snapshots(spark.createDataFrame(rows, "run_id string, source string, request_key string, target_date string, payload string, parameters map<string,string>"), f"{tmp_path}/landed")
    got = {r.request_key: r.payload_hash for r in spark.read.parquet(f"{tmp_path}/landed").select(F.col("request_key").cast("string").alias("request_key"), "payload_hash").collect()}
    assert got == {str(i): hashlib.sha256(json.dumps({"a": "x" * 300_000, "b": i}).encode()).hexdigest() for i in range(40)}
    assert seen and max(seen) <= 4 << 20 and spark.conf.get(NAME) == before
