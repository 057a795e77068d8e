"""Point-in-time factors of every stock and session: trailing prices, institutional flows, revenue growth, valuations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.mappers import place
from .asof import asof_join

MARKETS = ("TWSE", "TPEX")


def last_wins(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row of each key that comes last in ``order``, which must be unique within a key."""
    w = Window.partitionBy(*keys).orderBy(order.desc())
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def institutional_flows(rows: DataFrame) -> DataFrame:
    """Net shares by (stock_id, trading_date) over investor categories; one row with a null side leaves out its whole date.

    Where rows say which payload they come from (``landed``), a stock's date is that of its last payload: categories are summed within one.
    """
    sums = [F.sum(F.col("buy") - F.col("sell")).alias("net_shares"), F.bool_or(F.col("buy").isNull() | F.col("sell").isNull()).alias("bad")]
    if "landed" in rows.columns:
        g = rows.groupBy("stock_id", "trading_date", "landed").agg(*sums).groupBy("stock_id", "trading_date").agg(F.max_by(F.struct("net_shares", "bad"), "landed").alias("r"))
        g = g.select("stock_id", "trading_date", "r.*")
    else:
        g = rows.groupBy("stock_id", "trading_date").agg(*sums)
    return g.where(~F.col("bad")).drop("bad")


def monthly_revenue(rows: DataFrame) -> DataFrame:
    """Usable revenue rows: a year, a month of 1 to 12 and revenue that is whole and not negative."""
    return rows.where("revenue_year > 0 and revenue_month between 1 and 12 and revenue >= 0 and revenue = floor(revenue)")


def revenue_revisions(revenue: DataFrame) -> DataFrame:
    """One row per stock, period and date of knowledge, with its ``rank`` among equals: from the last payload, and there the first."""
    d = revenue if "row_date" in revenue.columns else revenue.withColumn("row_date", F.lit(None).cast("date"))
    first = -F.col("ordinal").cast("long") if "ordinal" in d.columns else -F.col("revenue")
    order = F.struct(*(["landed"] if "landed" in d.columns else []), first.alias("first"))
    one = d.groupBy("stock_id", "revenue_year", "revenue_month", "available_at").agg(F.max_by(F.struct("revenue", "row_date"), order).alias("r"))
    return one.select("stock_id", "revenue_year", "revenue_month", "available_at", "r.revenue", "r.row_date")


def revenue_growth(revenue: DataFrame, lookback_days: int | None = None) -> DataFrame:
    """stock_id, trading_date, yoy: growth of the newest known period, from each date on which it may have changed.

    Two clocks rule: a row is there from the day after its row_date until it is ``lookback_days`` old (None: it always is), and it is known from
    available_at on. The period is the greatest (year, month, available_at) of the rows that are there and known; the year before is
    looked up in its latest revision among those that are there, known or not, rows without a date last. Of equal revisions
    see ``revenue_revisions``. Null where the year before is absent or not positive, and once no row is known any more.

    Rows are not paired with dates: a stock's rows enter and leave in one ordered pass, whose frame holds the rows of the look-back, about one a month.
    """
    r = revenue_revisions(revenue)
    row = F.struct("revenue_year", "revenue_month", "available_at", "revenue")
    if lookback_days is None:
        w = Window.partitionBy("stock_id").orderBy("available_at").rangeBetween(Window.unboundedPreceding, 0)
        newest = r.where(F.col("available_at").isNotNull()).select("stock_id", F.col("available_at").alias("trading_date"), F.max(row).over(w).alias("b")).distinct()
        prior = r.groupBy("stock_id", (F.col("revenue_year") + 1).alias("y"), F.col("revenue_month").alias("m")).agg(
            F.max_by("revenue", F.coalesce("available_at", F.lit("0001-01-01").cast("date"))).alias("prior"))
        n = newest.select("stock_id", "trading_date", F.col("b.revenue_year").alias("y"), F.col("b.revenue_month").alias("m"), F.col("b.revenue").alias("now"))
        return n.join(prior, ["stock_id", "y", "m"], "left").select("stock_id", "trading_date", F.when(F.col("prior") > 0, F.col("now") / F.col("prior") - 1).alias("yoy"))
    if lookback_days < 1:
        raise ValueError("a look-back has one day at least")
    day = lambda c: F.unix_date(c)
    here = day(F.col("row_date")) + 1
    r = r.where(F.col("row_date").isNotNull()).select("stock_id", here.alias("here"), row.alias("row"))
    known = F.greatest("here", day(F.col("row.available_at")))
    # a row enters as a row; that it is known, and that it is too old, are moments only
    enter = r.select("stock_id", F.col("here").alias("at"), "row")
    moments = r.select("stock_id", F.explode(F.array(known, F.col("here") + lookback_days)).alias("at"), F.lit(None).cast(r.schema["row"].dataType).alias("row"))
    frame = Window.partitionBy("stock_id").orderBy("at").rangeBetween(1 - lookback_days, 0)
    d = enter.unionByName(moments.where("at is not null").distinct()).withColumn("rows", F.collect_list("row").over(frame))
    told = F.filter("rows", lambda x: day(x["available_at"]) <= F.col("at"))
    d = d.select("stock_id", "at", "rows", F.array_max(told).alias("best")).dropDuplicates(["stock_id", "at"])
    same = F.filter("rows", lambda x: (x["revenue_year"] == F.col("best.revenue_year") - 1) & (x["revenue_month"] == F.col("best.revenue_month")))
    prior = F.array_max(F.transform(same, lambda x: F.struct(F.coalesce(x["available_at"], F.lit("0001-01-01").cast("date")).alias("a"), x["revenue"].alias("revenue"))))["revenue"]
    d = d.withColumn("prior", prior)
    return d.select("stock_id", F.date_from_unix_date("at").alias("trading_date"), F.when(F.col("prior") > 0, F.col("best.revenue") / F.col("prior") - 1).alias("yoy"))


def point_in_time(
    targets: DataFrame, bars: DataFrame | None = None, flows: DataFrame | None = None, revenue: DataFrame | None = None,
    sessions: int = 5, lookback_days: int | None = None, revenue_days: int | None = None,
) -> DataFrame:
    """targets (stock_id, trading_date, close, volume, ...) with average_turnover_20d, volume_ratio_20d, return_5d, return_20d,
    net_buy_ratio, revenue_yoy and has_history.

    Prices: the last 20 sessions with close > 0, volume >= 0 and turnover >= 0 strictly before the date; fewer give null. Several bars on one
    date are a session each, in their order (``mappers.place``), but only those of the date's last payload. Flows: net shares over volume of
    the last ``sessions`` dates with volume, strictly before, where a date's volume is that of its last bar; null if a flow is absent, or if the stock has two
    flows on any earlier date. Revenue: growth as known on the date itself, of rows at most ``revenue_days`` old (see ``revenue_growth``).
    ``lookback_days`` is how far back history counts (None: always): older sessions make a factor null, older bars are no history, and a
    date with two flows before that voids nothing. A source that is None or
    lacks a stock leaves nulls and never drops a target; repeated targets repeat.

    All sources are merged into one stream per stock and dealt once, by stock_id; every window and look-up runs in that order.
    """
    if sessions <= 0:
        raise ValueError("sessions must be positive")
    kinds = {"target": targets.select(F.struct("*").alias("x")).schema["x"].dataType, "bar": "struct<close:double,volume:double,turnover:double>", "net": "bigint", "rev": "struct<yoy:double>"}
    if bars is not None:
        at = F.struct(*place(bars)) if place(bars) else F.struct(F.lit(0).alias("ordinal"))
        bar = F.struct(at.alias("o"), *[F.col(c).cast("double").alias(c) for c in ("close", "volume", "turnover")])
        kinds["bar"] = bars.select(bar.alias("x")).schema["x"].dataType
    # targets may clash with these names; they travel as one struct
    def part(df: DataFrame, **made: Column) -> DataFrame:
        return df.select("stock_id", "trading_date", *[made.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()])

    all_ = part(targets, target=F.struct("*"))
    if bars is not None:
        all_ = all_.unionByName(part(bars, bar=bar))
    if flows is not None:
        all_ = all_.unionByName(part(flows, net=F.col("net_shares")))
    if revenue is not None:
        all_ = all_.unionByName(part(revenue_growth(revenue, revenue_days), rev=F.struct("yoy")))
    d = all_.repartition("stock_id").groupBy("stock_id", "trading_date").agg(
        F.collect_list("target").alias("targets"), F.sort_array(F.collect_list("bar")).alias("bars"), F.sum("net").alias("net"), F.count("net").alias("n_net"), F.first("rev", ignorenulls=True).alias("rev"))
    if bars is not None and "landed" in bars.columns:
        d = d.withColumn("bars", F.filter("bars", lambda x: x["o"]["landed"].eqNullSafe(F.element_at("bars", -1)["o"]["landed"])))
    # a row per bar; what a date has once is looked up in its first row, before which there are earlier dates only
    d = d.select("*", F.posexplode_outer("bars").alias("at", "bar")).withColumn("at", F.coalesce("at", F.lit(0)))
    b, day, last = F.col("bar"), F.col("trading_date"), F.col("at") >= F.size("bars") - 1
    usable = F.coalesce((b["close"] > 0) & (b["volume"] >= 0) & (b["turnover"] >= 0), F.lit(False))
    traded = F.coalesce(last & (b["volume"] > 0), F.lit(False))
    d = d.withColumns({"usable": usable, "traded": traded})
    order = Window.partitionBy("stock_id", "usable").orderBy("trading_date", "at")
    w20, w5 = order.rowsBetween(-19, 0), Window.partitionBy("stock_id", "traded").orderBy("trading_date").rowsBetween(1 - sessions, 0)
    full = F.count(F.lit(1)).over(w20) == 20
    flow = F.when(F.count("net").over(w5) == sessions, F.sum("net").over(w5) / F.sum("bar.volume").over(w5))
    d = d.withColumns({
        "p": F.when(F.col("usable"), F.struct(
            F.when(full, F.avg("bar.turnover").over(w20)).alias("t20"), F.when(full, F.avg("bar.volume").over(w20)).alias("v20"),
            F.lag("bar.close", 4).over(order).alias("c5"), F.lag("trading_date", 4).over(order).alias("d5"),
            F.lag("bar.close", 19).over(order).alias("c20"), F.lag("trading_date", 19).over(order).alias("d20"),
        )),
        "f": F.when(F.col("traded"), F.struct(flow.alias("ratio"), F.min("trading_date").over(w5).alias("since"))),
    })
    before = Window.partitionBy("stock_id").orderBy("trading_date", "at").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("stock_id").orderBy("trading_date", "at").rowsBetween(Window.unboundedPreceding, 0)
    d = d.select(
        "trading_date", "targets", "at", F.last("p", ignorenulls=True).over(before).alias("p"), F.last("f", ignorenulls=True).over(before).alias("f"),
        F.last("rev", ignorenulls=True).over(upto)["yoy"].alias("yoy"), F.max(F.when(F.col("n_net") > 1, day)).over(before).alias("twice"), F.max(F.when(b.isNotNull(), day)).over(before).alias("bar_on"),
    ).where((F.size("targets") > 0) & (F.col("at") == 0)).withColumn("target", F.explode("targets"))

    def recent(since: Column) -> Column:
        return since.isNotNull() if lookback_days is None else F.coalesce(F.datediff(day, since) <= lookback_days, F.lit(False))

    def near(c: Column, since: Column) -> Column:
        return c if lookback_days is None else F.when(recent(since), c)

    t, p = F.col("target"), F.col("p")
    made = {
        "average_turnover_20d": near(p["t20"], p["d20"]),
        "volume_ratio_20d": near(F.when(p["v20"] > 0, t["volume"].cast("double") / p["v20"]), p["d20"]) if "volume" in targets.columns else None,
        "return_5d": near(F.when(p["c5"] > 0, t["close"].cast("double") / p["c5"] - 1), p["d5"]) if "close" in targets.columns else None,
        "return_20d": near(F.when(p["c20"] > 0, t["close"].cast("double") / p["c20"] - 1), p["d20"]) if "close" in targets.columns else None,
        "net_buy_ratio": near(F.when(~recent(F.col("twice")), F.col("f.ratio")), F.col("f.since")),
        "revenue_yoy": F.col("yoy"), "has_history": recent(F.col("bar_on")),
    }
    made = {k: v for k, v in made.items() if v is not None}
    return d.select(*[t[c].alias(c) for c in targets.columns if c not in made], *[v.alias(k) for k, v in made.items()])


def price_features(targets: DataFrame, bars: DataFrame) -> DataFrame:
    """targets (stock_id, trading_date, close, volume) with the four trailing price columns of ``point_in_time``."""
    return point_in_time(targets, bars).drop("net_buy_ratio", "revenue_yoy", "has_history")


def flow_ratio(targets: DataFrame, bars: DataFrame, flows: DataFrame, sessions: int = 5) -> DataFrame:
    """targets (stock_id, trading_date) with net_buy_ratio of ``point_in_time``."""
    return point_in_time(targets, bars, flows, sessions=sessions).select(*targets.columns, "net_buy_ratio")


def revenue_yoy(targets: DataFrame, revenue: DataFrame, revenue_days: int | None = None) -> DataFrame:
    """targets (stock_id, trading_date) with revenue_yoy of ``point_in_time``."""
    return point_in_time(targets, revenue=revenue, revenue_days=revenue_days).select(*targets.columns, "revenue_yoy")


def snapshot_ages(dates: DataFrame, valuations: DataFrame) -> DataFrame:
    """trading_date, market, snapshot_date (newest on or before the date, or null), age in days, for both markets of each date.

    A row for each date and market, so small at any number of stocks.
    """
    snaps = valuations.select("market", "snapshot_date").distinct().withColumn("trading_date", F.col("snapshot_date"))
    want = dates.select("trading_date").distinct().withColumn("market", F.explode(F.array(*map(F.lit, MARKETS))))
    j = asof_join(want, snaps, ["market"], "trading_date").select("trading_date", "market", F.col("match")["snapshot_date"].alias("snapshot_date"))
    return j.withColumn("age", F.datediff("trading_date", "snapshot_date"))


def newest_snapshots(dates: DataFrame, valuations: DataFrame, max_age_days: int = 5) -> DataFrame:
    """trading_date and the valuation rows that count on it: all rows of a market's newest snapshot on or before the date.

    A date counts only if both markets have a snapshot no older than ``max_age_days``.
    """
    near = snapshot_ages(dates, valuations).where(F.col("age") <= max_age_days)
    both = Window.partitionBy("trading_date")
    near = near.withColumn("n", F.count(F.lit(1)).over(both)).where(F.col("n") == len(MARKETS)).select("trading_date", "market", "snapshot_date")
    return near.join(valuations, ["market", "snapshot_date"])


def valuation_snapshots(dates: DataFrame, valuations: DataFrame, max_age_days: int = 5) -> DataFrame:
    """One row of ``newest_snapshots`` for each date and stock.

    Of one stock in both markets, TPEX stands, and of several rows in one the last (``mappers.place``).
    """
    order = F.struct((F.col("market") == "TPEX").alias("second"), *place(valuations), "pe_ratio")
    rows = newest_snapshots(dates, valuations, max_age_days)
    return rows.groupBy("trading_date", "stock_id").agg(F.max_by(F.struct("market", "snapshot_date", "pe_ratio"), order).alias("r")).select("trading_date", "stock_id", "r.*")


def filter_by_pe(rows: DataFrame, valuations: DataFrame, most: float | Column) -> DataFrame:
    """Rows whose stock has a record with 0 < P/E <= ``most`` on the date; no record or no P/E: out. Several records repeat no row."""
    if not isinstance(most, Column):
        if most <= 0:
            raise ValueError("the largest P/E must be positive")
        most = F.lit(float(most))
    ok = valuations.where(F.col("pe_ratio") > 0).select(F.col("trading_date").alias("__date"), F.col("stock_id").alias("__stock"), F.col("pe_ratio").cast("double").alias("__pe"))
    return rows.join(ok, (F.col("trading_date") == F.col("__date")) & (F.col("stock_id") == F.col("__stock")) & (F.col("__pe") <= most), "left_semi")
