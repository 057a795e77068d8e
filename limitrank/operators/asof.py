"""As-of join: each left row with the last right row at or before it, by one sort and no range product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, on: list[str], by: str, strict: bool = False, tolerance_days: int | None = None, bucket_days: int | None = None) -> DataFrame:
    """``left`` with a struct ``match`` of the right row that has the greatest ``by`` at or (``strict``) before the left's.

    ``by`` is a date. Right rows must be unique on (on, by). Beyond the tolerance, or without such a row, ``match`` is null. Rows are
    merged and the last right row is carried forward within a key, so the cost is one sort and not a product. A null in ``on`` is a key like
    others; a left row without a date has no match, a right row without one is none.

    With ``bucket_days`` a key is cut into spans of so many days, so that few or hot keys are dealt over many tasks: the last right row of each
    span is found first, the last one before each span is carried into it (one row per key and span), and then spans are merged
    as keys are without it. The rows are the same.
    """
    kinds = dict(left.dtypes)
    cell = [F.floor(F.unix_date("__at") / bucket_days).alias("__cell")] if bucket_days else []
    r = right.where(F.col(by).isNotNull()).select(*on, F.col(by).alias("__at"), F.struct(*right.columns).alias("__right"))
    lefts = left.select(*on, F.col(by).alias("__at"), F.struct(*left.columns).alias("__left"), F.lit(0 if strict else 1).alias("__tag"))
    keys = list(on)
    if bucket_days:
        if bucket_days < 1:
            raise ValueError("a span has one day at least")
        keys.append("__cell")
        r, lefts = r.select("*", *cell), lefts.select("*", *cell)
        # the last right row of each span, and a place for each span in which left rows ask
        summed = r.groupBy(*keys).agg(F.max_by("__right", "__at").alias("__last"))
        asked = lefts.where(F.col("__cell").isNotNull()).select(*keys).distinct().withColumn("__last", F.lit(None).cast(summed.schema["__last"].dataType))
        spans = summed.unionByName(asked).groupBy(*keys).agg(F.first("__last", ignorenulls=True).alias("__last"), F.count(F.lit(1)).alias("__n"))
        earlier = Window.partitionBy(*on).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
        carried = spans.select(*keys, F.last("__last", ignorenulls=True).over(earlier).alias("__right")).where(F.col("__right").isNotNull())
        # older than its span, so it comes first there
        r = r.unionByName(carried.withColumn("__at", F.col("__right")[by]))
    r = r.withColumns({"__left": F.lit(None).cast(lefts.schema["__left"].dataType), "__tag": F.lit(1 if strict else 0)})
    lefts = lefts.withColumn("__right", F.lit(None).cast(r.schema["__right"].dataType))
    w = Window.partitionBy(*keys).orderBy("__at", "__tag").rowsBetween(Window.unboundedPreceding, 0)
    out = lefts.unionByName(r).withColumn("match", F.last("__right", ignorenulls=True).over(w)).where(F.col("__left").isNotNull())
    out = out.withColumn("match", F.when(F.col("__at").isNotNull(), F.col("match")))
    if tolerance_days is not None:
        out = out.withColumn("match", F.when(F.datediff("__at", F.col("match")[by]) <= tolerance_days, F.col("match")))
    return out.select(*[F.col("__left")[c].alias(c) for c in kinds], "match")
