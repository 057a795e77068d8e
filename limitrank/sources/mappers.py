"""Typed tables from unpacked source rows (column ``fields``, a map of strings by the source's own names)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import MISSING, classify_security, iso_to_date, market_of, parse_decimal, parse_int, roc_to_date, strip
from ..functions.ticks import data_quality_ok

#: Names of the fields in each source (fixed values).
TWSE = {
    "date": "日期", "id": "證券代號", "volume": "成交股數", "turnover": "成交金額",
    "open": "開盤價", "high": "最高價", "low": "最低價", "close": "收盤價", "change": "漲跌價差",
}
TPEX = {
    "date": "Date", "id": "SecuritiesCompanyCode", "volume": "TradingShares", "turnover": "TransactionAmount",
    "open": "Open", "high": "High", "low": "Low", "close": "Close", "change": "Change",
}
HISTORY = {"date": "date", "id": "stock_id", "volume": "Trading_Volume", "turnover": "Trading_money", "open": "open", "high": "max", "low": "min", "close": "close"}
REVENUE = {"id": "stock_id", "date": "date", "year": "revenue_year", "month": "revenue_month", "revenue": "revenue", "told": "create_time"}
VALUATION = {"TWSE": {"date": "Date", "id": "Code", "pe": "PEratio"}, "TPEX": {"date": "Date", "id": "SecuritiesCompanyCode", "pe": "PriceEarningRatio"}}


def place(rows: DataFrame) -> list[str]:
    """The columns that say where a row stands: ``landed`` (its payload, see ``landing.current_payloads``), then ``ordinal`` (in it).

    What comes later counts where a key occurs again, so the order holds over all payloads, and in a frame of one payload without ``landed``.
    """
    return [c for c in ("landed", "ordinal") if c in rows.columns]


def _prices(rows: DataFrame, names: dict[str, str], commas: bool) -> DataFrame:
    """rows with open, high, low, close (zero is missing), volume and turnover (zero is a value)."""
    f = F.col("fields")
    made = {c: parse_decimal(f[names[c]], commas, zero_is_null=True) for c in ("open", "high", "low", "close")}
    made |= {"volume": parse_int(f[names["volume"]], commas), "turnover": parse_decimal(f[names["turnover"]], commas, kind="decimal(24,4)")}
    return rows.withColumns(made)


PRICE_COLUMNS = ["trading_date", "market", "stock_id", "open", "high", "low", "close", "reference", "volume", "turnover", "limit_up_price", "has_price_limit", "quality"]


def _finished(d: DataFrame, *more: Column | str) -> DataFrame:
    d = d.withColumns({"limit_up_price": F.lit(None).cast("decimal(18,4)"), "has_price_limit": F.lit(True)})
    return d.withColumn("quality", data_quality_ok(F.col("close"), F.col("high"), F.col("volume"), F.col("turnover"))).select(*PRICE_COLUMNS, *more)


def read_quotes(rows: DataFrame, market: str, target: str = "target_date") -> DataFrame:
    """Every row of an exchange's payload as a price, with target_date, market, on_date (it reports the target date) and named (it has an id).

    The reference is close less change. Both exchanges' fields for the next session are never read; the session's own limit price is not given by either.
    """
    names = {"TWSE": TWSE, "TPEX": TPEX}[market]
    f = F.col("fields")
    d = rows.withColumns({"trading_date": roc_to_date(f[names["date"]]), "stock_id": strip(f[names["id"]]), "market": F.lit(market)})
    d = d.withColumns({"on_date": F.col("trading_date").eqNullSafe(F.col(target)), "named": F.coalesce(F.col("stock_id") != "", F.lit(False))})
    d = _prices(d, names, commas=True).withColumn("reference", (F.col("close") - parse_decimal(f[names["change"]])).cast("decimal(18,4)"))
    return _finished(d, F.col(target).alias("target_date"), "on_date", "named")


def quotes_of(read: DataFrame) -> DataFrame:
    """Prices of ``read_quotes`` that have the target date and an id."""
    return read.where("on_date and named").select(*PRICE_COLUMNS)


def reports_of(read: DataFrame) -> DataFrame:
    """target_date, market, on_date (rows that report the date), mapped (those with an id too) of ``read_quotes``."""
    return read.groupBy("target_date", "market").agg(F.count_if("on_date").alias("on_date"), F.count_if(F.col("on_date") & F.col("named")).alias("mapped"))


def map_quotes(rows: DataFrame, market: str, target: str = "target_date") -> DataFrame:
    return quotes_of(read_quotes(rows, market, target))


def reported(rows: DataFrame, market: str, target: str = "target_date") -> DataFrame:
    return reports_of(read_quotes(rows, market, target))


def map_history(rows: DataFrame) -> DataFrame:
    """stock_id, trading_date, close, volume, turnover (doubles) of provider rows that are usable as a whole: an ISO date, a close other than zero, volume and turnover."""
    f = F.col("fields")
    d = rows.withColumns({"stock_id": strip(f["stock_id"]), "trading_date": iso_to_date(strip(f["date"]))})
    d = _prices(d, HISTORY, commas=False).where("stock_id <> '' and trading_date is not null and close is not null and volume is not null and turnover is not null")
    return d.select("stock_id", "trading_date", *[F.col(c).cast("double").alias(c) for c in ("close", "volume", "turnover")], *place(rows))


def map_prices_prev_close(rows: DataFrame, market: str, sessions: DataFrame) -> DataFrame:
    """Prices of provider rows whose reference is the close of the session before.

    ``sessions`` has trading_date and previous, the trading day before it. A close that is zero, missing or unreadable on that day
    is skipped; of several rows of a stock on it the later one counts. Without one the reference is null.
    """
    f = F.col("fields")
    d = rows.withColumns({"stock_id": strip(f["stock_id"]), "trading_date": iso_to_date(strip(f["date"])), "market": F.lit(market)})
    d = _prices(d.where("stock_id <> '' and trading_date is not null"), HISTORY, commas=False)
    closes = d.where("close is not null").groupBy("stock_id", F.col("trading_date").alias("previous")).agg(F.max_by("close", F.struct(*place(rows))).alias("reference"))
    # one row per day of the calendar, whatever the number of stocks
    return _finished(d.join(F.broadcast(sessions), "trading_date", "left").join(closes, ["stock_id", "previous"], "left"))


def stock_master(rows: DataFrame) -> DataFrame:
    """One row per stock of the two exchanges: stock_id, stock_name, market, security_type, industry, is_active and unknown risk states.

    Blank ids and other markets are dropped. An absent or empty name is the id, one of white space only is empty; a blank industry is null.
    Of several rows the last counts.
    """
    f, at = F.col("fields"), place(rows)
    stock_id, industry = strip(f["stock_id"]), F.nullif(strip(f["industry_category"]), F.lit(""))
    name = strip(F.coalesce(F.nullif(f["stock_name"], F.lit("")), f["stock_id"]))
    d = rows.select(stock_id.alias("stock_id"), market_of(f["type"]).alias("market"), name.alias("name"), industry.alias("industry"), *at)
    d = d.where("stock_id <> '' and market is not null")
    last = d.groupBy("stock_id").agg(F.max_by(F.struct("name", "market", "industry"), F.struct(*at, "market", "name", "industry")).alias("r"))
    return last.select(
        "stock_id", F.col("r.name").alias("stock_name"), "r.market", classify_security(F.col("stock_id"), F.col("r.name"), F.col("r.industry")).alias("security_type"), "r.industry",
        F.lit(True).alias("is_active"), *[F.lit(None).cast("boolean").alias(c) for c in ("attention", "disposition", "managed")],
    )


def map_flows(rows: DataFrame) -> DataFrame:
    """stock_id, trading_date, buy, sell of each investor category; unreadable counts are null, which later drops their date."""
    f = F.col("fields")
    d = rows.select(strip(f["stock_id"]).alias("stock_id"), iso_to_date(strip(f["date"])).alias("trading_date"), parse_int(f["buy"], False).alias("buy"), parse_int(f["sell"], False).alias("sell"), *place(rows))
    return d.where("stock_id <> '' and trading_date is not null")


def map_revenue(rows: DataFrame) -> DataFrame:
    """stock_id, revenue_year, revenue_month, revenue, available_at, row_date, landed and ordinal of usable rows.

    A year, a month of 1 to 12 and whole revenue that is not negative are needed. The first ten characters of create_time say when
    the row was known: blank is unknown, and what is no date drops the row. row_date is the provider's own date of the row, by which it is
    asked for; where that is missing or unreadable, the first day of the month after the row's.
    """
    f = F.col("fields")
    told = strip(F.coalesce(f[REVENUE["told"]], F.lit("")))
    d = rows.select(
        strip(f[REVENUE["id"]]).alias("stock_id"), *[parse_int(f[REVENUE[k]], False).alias(c) for k, c in (("year", "revenue_year"), ("month", "revenue_month"), ("revenue", "revenue"))],
        iso_to_date(F.substring(told, 1, 10)).alias("available_at"), (told == "").alias("untold"), iso_to_date(strip(f[REVENUE["date"]])).alias("row_date"), *place(rows),
    )
    d = d.where("stock_id <> '' and revenue_year > 0 and revenue_month between 1 and 12 and revenue >= 0 and (untold or available_at is not null)")
    kinds = {"revenue_year": "int", "revenue_month": "int", "revenue": "double"}
    d = d.withColumns({c: F.col(c).cast(t) for c, t in kinds.items()})
    after = F.try_to_date(F.concat_ws("-", F.lpad((F.col("revenue_year") + (F.col("revenue_month") == 12).cast("int")).cast("string"), 4, "0"), F.lpad((F.col("revenue_month") % 12 + 1).cast("string"), 2, "0"), F.lit("01")), "yyyy-MM-dd")
    return d.withColumn("row_date", F.coalesce("row_date", after)).drop("untold")


def map_valuations(rows: DataFrame, market: str) -> DataFrame:
    """market, snapshot_date, stock_id, pe_ratio, ordinal of rows with a date and an id; a marker of a missing value is null, a negative ratio stays."""
    names, f = VALUATION[market], F.col("fields")
    d = rows.select(F.lit(market).alias("market"), roc_to_date(f[names["date"]]).alias("snapshot_date"), strip(f[names["id"]]).alias("stock_id"), parse_decimal(f[names["pe"]], missing=MISSING).alias("pe_ratio"), *place(rows))
    return d.where("snapshot_date is not null and stock_id <> ''")


def session_calendar(days: DataFrame) -> DataFrame:
    """trading_date and previous for the distinct days of ``days``; one row per day, so the single ordered pass is short at any size."""
    w = Window.partitionBy(F.lit(0)).orderBy("trading_date")
    return days.select("trading_date").where("trading_date is not null").distinct().withColumn("previous", F.lag("trading_date").over(w))
