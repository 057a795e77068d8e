"""Shared pieces: stored intermediate tables, connected components, tiles for hot groups, streamed groups."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_FALLBACK: dict[str, str] = {}
#: Rows of one Arrow batch where whole texts travel; this changes memory only.
BATCH_ROWS = 1000
#: Bits of the map of ``possible`` for each id, and at most (4 MB).
FILTER_BITS, FILTER_MOST = 16, 1 << 25


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, or a new local one where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _FALLBACK.setdefault("dir", tempfile.mkdtemp(prefix="limitrank-"))
    return base.rstrip("/")


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go as soon as it is done, and not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stored(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet to the shared folder and read it back, which cuts its lineage; also returns the path."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    with released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written in buckets of ``key`` to the shared folder, so that joins on it move the other side only."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, key).option("path", f"{scratch_dir(spark)}/{name}").format("parquet").saveAsTable(name)
    return spark.table(name)


def drop_stored(spark: SparkSession, *paths: str) -> None:
    """Remove tables that ``stored`` wrote and that no later plan reads."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x"),
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node, component (smallest node reachable) for every end of ``edges``.

    Alternates large-star and small-star steps, each an aggregation joined back on the vertex, until the edge set is
    a set of stars. Minima are pre-aggregated and the joins are plain equi-joins, so adaptive execution can split a
    hub's edges. Every round is written to the shared folder, so a lost executor costs at most one round. Rows with a
    null end, loops and repeated edges are ignored; no edges give an empty result. Nodes may be integers or strings.
    """
    spark = edges.sparkSession
    u, v = F.col("u"), F.col("v")
    start = edges.select(F.greatest(F.col(a), F.col(b)).alias("u"), F.least(F.col(a), F.col(b)).alias("v"))
    current, path = stored(start.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (u != v)).distinct(), "edges")
    mark = _fingerprint(current)
    while mark[0]:
        both = current.unionByName(current.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v")).where(u != v).distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(
            F.explode(F.array(F.struct(v.alias("u"), F.col("m").alias("v")), F.struct(u.alias("u"), F.col("m").alias("v")))).alias("e")
        )
        after, new_path = stored(small.select("e.*").where(u != v).distinct(), "edges")
        new_mark = _fingerprint(after)
        drop_stored(spark, path)
        current, path, same = after, new_path, new_mark == mark
        mark = new_mark
        if same:
            break
    return current.select(u.alias("node"), v.alias("component")).unionByName(
        current.select(v.alias("node"), v.alias("component")).distinct()
    )


def possible(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` may be among that of ``ids``, and few others: what a join with ``ids`` need not move is left out before it.

    Ids are told apart by one bit of a map that is sent to all, of FILTER_BITS bits an id and FILTER_MOST at most, so it is small at any size;
    beyond that more rows pass, and none is ever lost.
    """
    bits = min(FILTER_BITS * ids.count() + 1, FILTER_MOST)
    slot = F.pmod(F.xxhash64(column), F.lit(bits)) + 1
    maps = ids.select(slot.alias("__slot")).select(F.bitmap_bucket_number("__slot").alias("__bucket"), F.bitmap_bit_position("__slot").alias("__bit"))
    maps = maps.repartition("__bucket").groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__map"))
    d = rows.withColumn("__slot", slot).withColumns({"__bucket": F.bitmap_bucket_number("__slot"), "__bit": F.bitmap_bit_position("__slot")})
    byte = F.conv(F.hex(F.substring("__map", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    held = F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1
    return d.join(F.broadcast(maps), "__bucket").where(held).select(*rows.columns)


def tile_keys(counts: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Keys with more than ``size`` rows and the number of tiles that each needs (column n_tiles)."""
    return counts.where(F.col("n") > size).select(*keys, F.ceil(F.col("n") / F.lit(size)).cast("int").alias("n_tiles"))


def tile_pair_column(n_tiles: Column, own: Column) -> Column:
    """Array of (i, j) tile pairs, i <= j, in which a row of tile ``own`` takes part."""
    other = F.sequence(F.lit(0), n_tiles - 1)
    return F.transform(other, lambda t: F.struct(F.least(t, own).alias("ti"), F.greatest(t, own).alias("tj")))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroup a stream sorted by ``keys`` into tables that never split a group; holds one batch and one group."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        first, last = [table.column(k)[0].as_py() for k in keys], [table.column(k)[-1].as_py() for k in keys]
        if held and [held[-1].column(k)[-1].as_py() for k in keys] == last == first:
            held.append(table)
            continue
        whole = pa.concat_tables([*held, table]) if held else table
        same = np.ones(whole.num_rows, dtype=bool)
        for k, value in zip(keys, last, strict=True):
            same &= np.asarray(whole.column(k).to_numpy() == value)
        cut = int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
        if cut:
            yield whole.slice(0, cut)
        held = [whole.slice(cut)]
    if held:
        yield pa.concat_tables(held)


def map_texts(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` for rows with whole texts, in less memory.

    Batches have at most BATCH_ROWS rows (a setting of the session, lowered where it is higher), as both ends hold a batch of each task;
    and workers, which are used again by later tasks, give back to the system what they no longer need.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name, "10000")) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in run(batches):
            yield made
            del made
            _give_back()
        _give_back()

    return df.mapInArrow(lean, schema)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library has it
    if trim is not None:
        trim(0)


def values(column: pa.Array, step: int = 256) -> Iterator:
    """Python values of a column, a few at a time, so that a batch of long texts is not held twice."""
    for i in range(0, len(column), step):
        yield from column.slice(i, step).to_pylist()


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which groups of equal ``keys`` begin, with the number of rows at the end."""
    n = table.num_rows
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for k in keys:
        col = table.column(k).to_numpy()
        new[1:] |= col[1:] != col[:-1]
    return np.append(np.flatnonzero(new), n)


def components_of_matrix(linked: np.ndarray) -> np.ndarray:
    """Smallest reachable row for each row of a symmetric boolean matrix."""
    n = len(linked)
    label = np.arange(n)
    while True:
        reach = np.where(linked, label[None, :], n).min(axis=1, initial=n)
        new = np.minimum(label, reach)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new
