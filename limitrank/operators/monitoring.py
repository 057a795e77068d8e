"""Source merging, readiness of dates and stage counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .factors import MARKETS, snapshot_ages


def merge_sources(primary: DataFrame, fallback: DataFrame, fields: list[str]) -> DataFrame:
    """One row per stock and date of ``primary``; a field that is null or 0 is taken from the fallback's row, where there is one, whatever it holds.

    ``has_price_limit`` stays the primary's, ``quality`` is that of both. Of several rows of a stock and date the last by
    ``ordinal`` counts on either side (without that column, the one that compares greatest).
    """
    keys = ["trading_date", "stock_id"]

    def one(df: DataFrame) -> DataFrame:
        order = F.struct("ordinal", *fields) if "ordinal" in df.columns else F.struct(*fields)
        kept = [c for c in (*fields, "has_price_limit", "quality") if c in df.columns]
        return df.groupBy(*keys).agg(F.max_by(F.struct(*kept), order).alias("r")).select(*keys, "r.*")

    p, f = one(primary), one(fallback)
    f = f.select(*keys, F.lit(True).alias("__there"), F.col("quality").alias("__q"), *[F.col(c).alias(f"__{c}") for c in fields])
    alone = F.col("__there").isNull()
    made = [F.when(alone | (F.col(c) != 0), F.col(c)).otherwise(F.col(f"__{c}")).alias(c) for c in fields]
    limit = ["has_price_limit"] if "has_price_limit" in p.columns else []
    return p.join(f, keys, "left").select(*keys, *made, *limit, (F.col("quality") & F.coalesce("__q", F.lit(True))).alias("quality"))


def is_trading_day(day: Column, holiday: Column) -> Column:
    """A weekday that is no holiday (``holiday``: whether it is in the list)."""
    return (F.weekday(day) < 5) & ~F.coalesce(holiday, F.lit(False))


def source_readiness(spine: DataFrame, payloads: DataFrame, rows: DataFrame, valuations: DataFrame, master: DataFrame, info: DataFrame | None = None, max_age_days: int = 5) -> DataFrame:
    """spine (trading_date, holiday) with n_twse, n_tpex (rows that report the date) and status.

    ``payloads``: target_date, market, kind (prices or valuations), well_formed. ``rows``: target_date, market, on_date, mapped (see
    ``mappers.reports_of``). ``info``: the rows that ``master`` is made from (None: master itself).

    Gates in order: no trading day (SKIPPED_NON_TRADING_DAY); for each market prices of the wrong form (FAILED) or none that report the
    date (WAITING_FOR_DATA); for each market valuations of the wrong form (FAILED) or no snapshot on or before the date
    (WAITING_FOR_DATA); for each market a snapshot older than ``max_age_days`` (WAITING_FOR_DATA); an empty ``info`` (FAILED); for each market no
    mapped row (WAITING_FOR_DATA); an empty ``master`` (FAILED); else READY.
    """
    names = [m.lower() for m in MARKETS]

    def by_market(df: DataFrame, key: str, **made: Column) -> DataFrame:
        return df.groupBy(F.col(key).alias("trading_date")).agg(*[
            agg(F.when(F.col("market") == m, c)).alias(f"{k}_{m.lower()}") for m in MARKETS for k, (agg, c) in made.items()
        ])

    wrong = {kind: (F.bool_or, ~F.coalesce("well_formed", F.lit(False)) & (F.col("kind") == kind)) for kind in ("prices", "valuations")}
    bad = by_market(payloads, "target_date", **wrong)
    n = by_market(rows, "target_date", n=(F.sum, F.col("on_date")), ok=(F.sum, F.col("mapped")))
    age = by_market(snapshot_ages(spine, valuations), "trading_date", age=(F.max, F.col("age")))
    d = spine.join(bad, "trading_date", "left").join(n, "trading_date", "left").join(age, "trading_date", "left")
    d = d.na.fill(0, [f"{k}_{m}" for m in names for k in ("n", "ok")]).na.fill(False, [f"{k}_{m}" for m in names for k in wrong])
    # one row each, looked up by the plan itself; a first row is enough
    some = {k: df.select(F.lit(1).alias("x")).limit(1).select(F.count("x")).scalar() for k, df in (("n_info", info if info is not None else master), ("n_master", master))}
    d = d.withColumns(some)
    waiting, failed = "WAITING_FOR_DATA", "FAILED"
    status = F.when(~is_trading_day(F.col("trading_date"), F.col("holiday")), "SKIPPED_NON_TRADING_DAY")
    for m in names:
        status = status.when(F.col(f"prices_{m}"), failed).when(F.col(f"n_{m}") == 0, waiting)
    for m in names:
        status = status.when(F.col(f"valuations_{m}"), failed).when(F.col(f"age_{m}").isNull(), waiting)
    for m in names:
        status = status.when(F.col(f"age_{m}") > max_age_days, waiting)
    status = status.when(F.col("n_info") == 0, failed)
    for m in names:
        status = status.when(F.col(f"ok_{m}") == 0, waiting)
    status = status.when(F.col("n_master") == 0, failed).otherwise("READY")
    return d.select("trading_date", *[f"n_{m}" for m in names], status.alias("status"))


def funnel(stages: dict[str, DataFrame], by: tuple[str, ...] = ("trading_date",)) -> DataFrame:
    """Rows per ``by`` that reached each stage."""
    tagged = None
    for name, df in stages.items():
        part = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(*by).agg(*[F.coalesce(F.sum(F.when(F.col("stage") == s, F.col("n"))), F.lit(0)).alias(s) for s in stages])


def enrichment_states(rows: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """rows with price_state, flow_state and revenue_state: success, failed, and empty (prices) or none (the others).

    Prices succeed when the stock has any history before the date, the others when their factor is known. ``failures`` (stock_id,
    trading_date, source of price, flow or revenue) names requests that failed; without it none did.
    """
    d = rows
    if failures is not None:
        f = failures.groupBy("stock_id", "trading_date").agg(F.collect_set("source").alias("__failed"))
        d = d.join(f, ["stock_id", "trading_date"], "left")
    failed = (lambda s: F.coalesce(F.array_contains("__failed", s), F.lit(False))) if failures is not None else (lambda _: F.lit(False))
    d = d.withColumns({
        "price_state": F.when(failed("price"), "failed").when(F.col("has_history"), "success").otherwise("empty"),
        "flow_state": F.when(failed("flow"), "failed").when(F.col("net_buy_ratio").isNotNull(), "success").otherwise("none"),
        "revenue_state": F.when(failed("revenue"), "failed").when(F.col("revenue_yoy").isNotNull(), "success").otherwise("none"),
    })
    return d.drop("__failed")


def enrichment_coverage(rows: DataFrame, by: tuple[str, ...] = ("trading_date",)) -> DataFrame:
    """Counts of ``enrichment_states`` and of risk outcomes per ``by``: failed (see ``ranking.assess_risk``), excluded, incomplete (which
    counts before flagged), flagged and clean."""
    failed = F.col("exclusion").eqNullSafe("risk_failed")
    excluded = F.col("exclusion").isNotNull() & ~failed
    incomplete = ~excluded & ~failed & (F.size("missing_inputs") > 0)
    flagged = ~excluded & ~failed & ~incomplete & (F.size("risk_flags") > 0)
    states = [(f"{s}_state", x) for s, none in (("price", "empty"), ("flow", "none"), ("revenue", "none")) for x in ("success", none, "failed")]
    return rows.groupBy(*by).agg(
        *[F.count_if(F.col(c) == x).alias(f"{c.removesuffix('_state')}_{x}") for c, x in states],
        F.count_if(excluded).alias("excluded"), F.count_if(incomplete).alias("incomplete"), F.count_if(flagged).alias("flagged"),
        F.count_if(~excluded & ~failed & ~incomplete & ~flagged).alias("clean"), F.count_if(failed).alias("risk_failed"),
    )
