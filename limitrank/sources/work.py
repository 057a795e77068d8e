"""Tables that a job writes between its stages, in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, as in tests on a local master, a new local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _LOCAL.setdefault("dir", tempfile.mkdtemp(prefix="limitrank-"))
    return base.rstrip("/")


class WorkTables:
    """Writes tables once and reads them back, so that later stages start from a file and not from the whole plan before.

    A lost executor costs no earlier stage. ``drop`` removes what was written, when nothing reads it any more. ``counts`` has the rows of each
    table, which are counted while it is written and not by reading it again.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{work_dir(spark)}/job-{uuid.uuid4().hex}"
        self.counts: dict[str, int] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        self.counts[name] = seen.get["n"]
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, name: str) -> DataFrame:
        """A table that was written before."""
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def write_all(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Tables that do not depend on each other, written side by side."""
        with ThreadPool(max(1, len(tables))) as pool:
            return dict(pool.map(lambda x: (x[0], self.write(x[1], x[0])), tables.items()))

    def drop(self) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
