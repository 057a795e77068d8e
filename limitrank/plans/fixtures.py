"""The driver's tables read as market data: bars, quotes, flows, revenue, valuations, master and risk inputs."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ticks import limit_up_price
from ..sources import landing
from ..sources.work import WorkTables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k():
    return F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")


def _stock(user):
    return F.lpad(user.cast("string"), 4, "0")


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("trading_date"), F.struct("ts", "event_id").alias("at"), "value", _k().alias("k"))
    b = e.groupBy("user_id", "trading_date").agg(
        F.min_by("value", "at").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "at").alias("close"),
        F.sum("k").alias("volume"), F.round(F.sum(F.col("value") * F.col("k")) * 2000).alias("turnover"),
    )
    return b.select(_stock(F.col("user_id")).alias("stock_id"), F.when(F.col("user_id") % 2 == 0, "TWSE").otherwise("TPEX").alias("market"), "trading_date", "open", "high", "low", "close", "volume", "turnover", "user_id")


def quotes(bars: DataFrame) -> DataFrame:
    """Bars as prices with a reference; on every third day of a stock it closes at its limit, on some of them all day.

    From 10,000 users on, several share a cut id and its dates; they follow each other by user, so that reruns agree.
    """
    w = Window.partitionBy("stock_id").orderBy("trading_date", "user_id")
    d = bars.withColumn("reference", F.lag("close").over(w).cast("decimal(18,4)"))
    limit = limit_up_price(F.col("reference"))
    hit = ((F.col("user_id") + F.day("trading_date")) % 3 == 0) & limit.isNotNull()
    flat = hit & ((F.col("user_id") + F.day("trading_date")) % 5 == 0)
    dec = lambda c: F.col(c).cast("decimal(18,4)")
    d = d.select(
        "stock_id", "market", "trading_date", F.when(flat, limit).otherwise(dec("open")).alias("open"), F.when(hit, limit).otherwise(dec("high")).alias("high"), F.when(flat, limit).otherwise(dec("low")).alias("low"),
        F.when(hit, limit).otherwise(dec("close")).alias("close"), "volume", "turnover", "reference", F.lit(None).cast("decimal(18,4)").alias("limit_up_price"),
        F.lit(True).alias("has_price_limit"),
    )
    return d.withColumn("quality", F.coalesce(F.col("close").isNotNull() & F.col("high").isNotNull() & (F.col("volume") > 0) & (F.col("turnover") > 0), F.lit(False)))


def flow_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("event_type <> 'view'").select(_stock(F.col("user_id")).alias("stock_id"), F.to_date("ts").alias("trading_date"), "event_type", _k().alias("k"))
    buys = F.col("event_type").isin("purchase", "signup", "click")
    g = e.groupBy("stock_id", "trading_date", "event_type").agg(
        F.sum(F.when(buys, F.col("k")).otherwise(0)).alias("buy"), F.sum(F.when(~buys, F.col("k")).otherwise(0)).alias("sell"), F.bool_or(F.col("k") == 97).alias("bad")
    )
    return g.select("stock_id", "trading_date", "event_type", F.when(~F.col("bad"), F.col("buy")).alias("buy"), "sell")


#: Orders are older than events by so many years; revenue is moved, so that it is known when events happen.
YEARS = 22


def revenue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    g = o.groupBy(F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("stock_id"), (F.year("o_orderdate") + YEARS).alias("revenue_year"), F.month("o_orderdate").alias("revenue_month"), "c_nationkey").agg(F.round(F.sum("o_totalprice"), 0).alias("revenue"))
    at = F.date_add(F.add_months(F.make_date("revenue_year", "revenue_month", F.lit(10)), 1), F.col("c_nationkey") % 7)
    row_date = F.add_months(F.make_date("revenue_year", "revenue_month", F.lit(1)), 1)
    return g.select("stock_id", "revenue_year", "revenue_month", "revenue", F.when(F.col("revenue_year") >= 1997 + YEARS, at).alias("available_at"), row_date.alias("row_date"))


def master(bars: DataFrame) -> DataFrame:
    """One row per stock; every 11th is a fund."""
    n = F.col("stock_id").cast("int")
    return bars.select("stock_id", "market").distinct().select(
        "stock_id", F.concat(F.lit("Stock "), "stock_id", F.when(n % 7 == 0, F.lit("-KY")).otherwise(F.lit(""))).alias("stock_name"), "market",
        F.when(n % 11 == 0, "ETF").otherwise("COMMON_STOCK").alias("security_type"), F.lit(True).alias("is_active"),
    )


def valuations(bars: DataFrame) -> DataFrame:
    """Snapshots on four days of a month and market; P/E from the close, null or negative for some."""
    n = F.col("stock_id").cast("int")
    pe = F.when(n % 10 == 3, None).when(n % 10 == 7, -5.0).otherwise(F.round(F.col("close") / 10, 2))
    return bars.where(F.day("trading_date").isin(5, 6, 14, 23)).select("market", F.col("trading_date").alias("snapshot_date"), "stock_id", pe.alias("pe_ratio"))


def risk_inputs(rows: DataFrame) -> DataFrame:
    """Three-state flags that the id decides, and an error for every 29th."""
    n = F.col("stock_id").cast("int")
    tri = lambda k: F.when(n % k == 0, True).when(n % k == 1, False)
    return rows.withColumns({"attention": tri(3), "disposition": n % 17 == 0, "managed": F.when(n % 19 != 0, n % 23 == 0), "streak": F.when(n % 6 != 5, n % 6), "risk_error": F.when(n % 29 == 0, "no answer")})


#: Rows of one rendered payload: stocks of one page.
PAGE = 500


def _paged(df: DataFrame, keys: list[str], item: Column, first: str, sep: str, last: str) -> DataFrame:
    """Payloads of up to about PAGE stocks each: ``first``, the rows' texts in order of stock and, where rows have it, user, ``last``."""
    page = F.floor(F.col("stock_id").cast("int") / PAGE).alias("page")
    g = df.select(*keys, page, F.struct(*[c for c in ("stock_id", "user_id") if c in df.columns], item.alias("t")).alias("r")).groupBy(*keys, "page").agg(F.sort_array(F.collect_list("r")).alias("r"))
    return g.select(*keys, "page", F.concat(F.lit(first), F.array_join(F.col("r.t"), sep), F.lit(last)).alias("payload"))


def _roc(day: str) -> Column:
    return F.concat(F.lpad((F.year(day) - 1911).cast("string"), 3, "0"), F.date_format(day, "MMdd"))


def _number(c: Column | str, digits: int = 4) -> Column:
    return F.coalesce(F.format_number(c, digits), F.lit("--"))


def price_payloads(q: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quotes as the two exchanges send them, by target_date: CSV with quoted cells that hold commas, quotes and line breaks; a JSON array
    with fields of the next session, signed changes and an element that is no object. Rows of another date are among them."""
    change = F.col("close") - F.col("reference")
    cells = {
        "日期": _roc("trading_date"), "證券代號": F.col("stock_id"), "證券名稱": F.concat(F.lit('Stock ""'), "stock_id", F.lit('"",\n Inc')), "成交股數": F.format_number("volume", 0),
        "成交金額": F.format_number("turnover", 0), "開盤價": _number("open"), "最高價": _number("high"), "最低價": _number("low"), "收盤價": _number("close"), "漲跌價差": _number(change), "成交筆數": F.lit("1"),
    }
    line = F.concat_ws(",", *[F.concat(F.lit('"'), c, F.lit('"')) for c in cells.values()])
    signed = F.when(change >= 0, F.concat(F.lit("+"), _number(change))).otherwise(_number(change))
    item = F.to_json(F.struct(*[c.alias(n) for n, c in {
        "Date": _roc("trading_date"), "SecuritiesCompanyCode": F.concat(F.lit(" "), "stock_id"), "CompanyName": F.lit("x"), "Close": _number("close"), "Change": signed, "Open": _number("open"),
        "High": _number("high"), "Low": _number("low"), "TradingShares": F.format_number("volume", 0), "TransactionAmount": F.format_number("turnover", 0),
        "NextReferencePrice": F.lit("1"), "NextLimitUp": F.lit("1.1"), "NextLimitDown": F.lit("0.9"),
    }.items()]))
    d = q.withColumn("target_date", F.col("trading_date"))
    csv = _paged(d.where("market = 'TWSE'"), ["target_date"], line, ",".join(cells) + "\n", "\n", '\n"1010101","9999"')
    js = _paged(d.where("market = 'TPEX'"), ["target_date"], item, "[17,", ",", ',{"Date":"1010101","SecuritiesCompanyCode":"9999"}]')
    return csv, js


def raw_sources(spark: SparkSession, sf_dir: str, late: bool = True, bars: DataFrame | None = None) -> DataFrame:
    """Payloads of every source: source, target_date, request_key, payload.

    With ``late``, one market does not report on days divisible by 9 and sends no JSON array on the 22nd; on the 25th the other sends no array of valuations.
    """
    b = daily_bars(spark, sf_dir) if bars is None else bars
    q = quotes(b)
    csv, js = price_payloads(q if not late else q.where((F.day("trading_date") % 9 != 0) | (F.col("market") == "TWSE")))
    down = F.lit('{"error":"down"}')
    if late:
        js = js.withColumn("payload", F.when(F.day("target_date") == 22, down).otherwise(F.col("payload")))
    pe = F.when(F.col("pe_ratio").isNull(), F.lit("N/A")).otherwise(F.format_number("pe_ratio", 2))
    v = valuations(b)
    value = lambda code, name: F.to_json(F.struct(_roc("snapshot_date").alias("Date"), F.col("stock_id").alias(code), pe.alias(name)))
    m = master(b)
    kind = F.when(F.col("security_type") == "ETF", "domestic etf").otherwise("steel")
    info = F.to_json(F.struct("stock_id", "stock_name", F.lower("market").alias("type"), kind.alias("industry_category"), F.lit("2024-01-01").alias("date")))
    old = F.to_json(F.struct("stock_id", F.lit("old name").alias("stock_name"), F.lit("tpex").alias("type"), F.lit("etf").alias("industry_category")))
    h = F.to_json(F.struct(F.col("trading_date").cast("string").alias("date"), "stock_id", "open", F.col("high").alias("max"), F.col("low").alias("min"), "close", F.col("volume").alias("Trading_Volume"), F.col("turnover").cast("decimal(24,2)").alias("Trading_money")))
    f = F.to_json(F.struct(F.col("trading_date").cast("string").alias("date"), "stock_id", F.col("event_type").alias("name"), F.coalesce(F.col("buy").cast("string"), F.lit("bad")).alias("buy"), "sell"))
    told = F.concat(F.col("available_at").cast("string"), F.lit(" 09:15:00"))
    # every other month comes without a date of its own
    dated = F.when(F.col("revenue_month") % 2 == 0, F.col("row_date").cast("string"))
    r = F.to_json(F.struct("stock_id", "revenue_year", "revenue_month", F.col("revenue").cast("bigint").alias("revenue"), F.coalesce(told, F.lit("")).alias("create_time"), dated.alias("date")))
    one_day = lambda df: (df.withColumn("day", F.lit(datetime.date(2024, 1, 30))), "day")  # noqa: E731  asked for once, for all days
    made = {
        "prices_twse": (csv, "target_date"), "prices_tpex": (js, "target_date"),
        "valuations_twse": (_paged(v.where("market = 'TWSE'"), ["snapshot_date"], value("Code", "PEratio"), "[", ",", "]"), "snapshot_date"),
        "valuations_tpex": (_paged(v.where("market = 'TPEX'"), ["snapshot_date"], value("SecuritiesCompanyCode", "PriceEarningRatio"), "[", ",", "]"), "snapshot_date"),
        "info": one_day(_paged(m, [], F.concat_ws(",", old, info), '{"data":[{"stock_id":" ","type":"twse"},{"stock_id":"7777","type":"emerging"},', ",", "]}")),
        "history": one_day(_paged(b, ["trading_date"], h, '{"data":[{"date":"2024-1-1","stock_id":"0001","close":1,"Trading_Volume":1,"Trading_money":1},', ",", "]}")),
        "flows": one_day(_paged(flow_rows(spark, sf_dir), ["trading_date"], f, '{"data":[', ",", "]}")),
        "revenue": one_day(_paged(revenue_rows(spark, sf_dir), ["row_date"], r, '{"data":[{"stock_id":"0001","revenue_year":1999,"revenue_month":13,"revenue":1},', ",", "]}")),
    }
    out = None
    for source, (df, day) in made.items():
        key = F.concat_ws("|", F.lit(source), *[F.col(c).cast("string") for c in df.columns if c not in ("payload", day)])
        part = df.select(F.lit(source).alias("source"), F.col(day).alias("target_date"), key.alias("request_key"), "payload")
        out = part if out is None else out.unionByName(part)
    if late:
        bad = b.where(F.day("trading_date") == 25).select("trading_date").distinct().select(F.lit("valuations_twse").alias("source"), F.col("trading_date").alias("target_date"), F.lit("valuations_twse|0").alias("request_key"), down.alias("payload"))
        out = out.unionByName(bad)
    return out


def landed(spark: SparkSession, sf_dir: str, work: WorkTables, late: bool = True, three: bool = False) -> tuple[DataFrame, DataFrame]:
    """``raw_sources`` as landed by one run a day and the runs; with ``three``, by three runs a day that together give the same.

    The first run ends early and has most payloads wrong, the second has those that the first had wrong and ends later, the third has all wrong and
    fails last.
    """
    raw = raw_sources(spark, sf_dir, late, work.write(daily_bars(spark, sf_dir), "bars"))
    name = lambda x: F.concat_ws("-", F.col("target_date").cast("string"), F.lit(x))
    wrong, fifth = F.regexp_replace("payload", "1", "2"), F.crc32(F.concat("request_key", F.col("target_date").cast("string"))) % 5 == 0
    sent = [F.struct(name("b").alias("run_id"), F.col("payload"))]
    if three:
        sent = [F.struct(name("a").alias("run_id"), F.when(fifth, F.col("payload")).otherwise(wrong).alias("payload")), F.when(~fifth, sent[0]), F.struct(name("c").alias("run_id"), wrong.alias("payload"))]
    rows = raw.select("source", "target_date", "request_key", F.explode(F.array_compact(F.array(*sent))).alias("s")).select("s.run_id", "source", "request_key", "target_date", "s.payload")
    path = f"{work.folder}/landed"
    landing.append_snapshots(rows.withColumn("parameters", F.create_map(F.lit("token"), F.lit("x"))), path)
    kept = spark.read.parquet(path)
    at = F.col("target_date").cast("timestamp")
    run = lambda x, minutes, status: F.struct(name(x).alias("run_id"), (at + F.expr(f"interval {minutes} minutes")).alias("finished_at"), F.lit(status).alias("status"))
    runs = kept.select("target_date").distinct().select(F.explode(F.array(run("a", 977, "SUCCESS"), run("b", 1007, "SUCCESS"), run("c", 1037, "FAILED"))).alias("r")).select("r.*")
    return kept, runs


def spine(bars: DataFrame) -> DataFrame:
    return bars.select("trading_date").distinct().withColumn("holiday", F.day("trading_date").isin(1, 17))
