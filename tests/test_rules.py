"""Small cases of single rules."""

import datetime
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from limitrank.functions import parsing, ticks
from limitrank.operators import asof, delivery, factors, monitoring, ranking, reports
from limitrank.plans import jobs
from limitrank.sources import landing, mappers, strategies
from limitrank.sources.work import WorkTables

STRATEGY = strategies.load_strategies()[0]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("price", "tick"), [("0", "0.01"), ("9.99", "0.01"), ("10", "0.05"), ("49.95", "0.05"), ("50", "0.10"), ("100", "0.50"), ("500", "1"), ("1000", "5")])
def test_tick_bands(spark, price, tick):
    assert one(spark, ticks.tick_size(F.lit(price).cast("decimal(18,4)"))) == Decimal(tick)


def test_limit_price_is_a_legal_step_below_a_tenth(spark):
    assert one(spark, ticks.limit_up_price(F.lit("40.60").cast("decimal(18,4)"))) == Decimal("44.65")
    assert one(spark, ticks.limit_up_price(F.lit("0").cast("decimal(18,4)"))) is None
    refs = spark.range(1, 3000).select((F.col("id") * F.lit("0.37").cast("decimal(4,2)")).cast("decimal(18,4)").alias("r"))
    p = refs.withColumn("l", ticks.limit_up_price(F.col("r")))
    raw = (F.col("r") * F.lit("1.10").cast("decimal(3,2)")).cast("decimal(18,4)")
    t = ticks.tick_size(raw)
    assert p.where((F.col("l") > raw) | (F.col("l") + t <= raw) | (F.col("l") % t != 0)).count() == 0


def test_dates_and_numbers(spark):
    assert one(spark, parsing.roc_to_date(F.lit("1130229"))) == datetime.date(2024, 2, 29)
    assert one(spark, parsing.roc_to_date(F.lit("1130230"))) is None
    assert one(spark, parsing.iso_to_date(F.lit("2026-8-1"))) is None
    assert one(spark, parsing.parse_decimal(F.lit(" 1,234.5 "))) == Decimal("1234.5")
    assert one(spark, parsing.parse_decimal(F.lit("NaN"))) is None
    assert one(spark, parsing.parse_int(F.lit("7.5"))) is None


def test_momentum(spark):
    want = {-1.0: 0, 0.0: 50, 0.03: 100, 0.15: 100, 0.40: 20}
    assert {r: one(spark, ticks.bounded_momentum_score(F.lit(r))) for r in want} == want


def test_asof_strict_and_tolerance(spark):
    day = lambda n: datetime.date(2024, 1, n)
    left = spark.createDataFrame([("a", day(5)), ("a", day(20)), ("b", day(5))], "k string, d date")
    right = spark.createDataFrame([("a", day(5), 1), ("a", day(3), 2)], "k string, d date, v int")
    got = lambda **x: {(r.k, r.d.day): r.v for r in asof.asof_join(left, right, ["k"], "d", **x).select("k", "d", "match.v").collect()}
    assert got() == {("a", 5): 1, ("a", 20): 1, ("b", 5): None}
    assert got(strict=True, tolerance_days=5) == {("a", 5): 2, ("a", 20): None, ("b", 5): None}


def test_a_bad_flow_row_poisons_its_date_only(spark):
    rows = spark.createDataFrame([("1", 1, 5, 2), ("1", 1, None, 2), ("1", 2, 5, 2)], "stock_id string, trading_date int, buy long, sell long")
    assert [tuple(r) for r in factors.institutional_flows(rows).collect()] == [("1", 2, 3)]


def test_future_rows_never_change_the_past(spark):
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    bars = spark.createDataFrame([("1", day(i), 10.0 + i, 100 + i, 5.0 * i + 1) for i in range(40)], "stock_id string, trading_date date, close double, volume long, turnover double")
    target = bars.where(F.col("trading_date") == day(25)).select("stock_id", "trading_date", "close", "volume")
    early = factors.price_features(target, bars.where(F.col("trading_date") <= day(25))).collect()
    assert early == factors.price_features(target, bars).collect()
    assert early[0].return_5d == pytest.approx(35 / 30 - 1)


RISK = "attention boolean, disposition boolean, managed boolean, streak int, return_5d double, stock_name string, one_price boolean"


def test_unknown_flags_never_exclude(spark):
    rows = spark.createDataFrame([(None, None, None, None, None, "x", None), (True, False, False, 4, 0.35, "a-KY", True), (False, False, False, 3, 0.1, "x", False), (True, True, None, 9, 0.9, "x", True)], RISK)
    got = [(r.exclusion, r.risk_flags, r.missing_inputs, r.risk_quality) for r in ranking.assess_risk(strategies.for_each_strategy(rows, [STRATEGY])).collect()]
    every = ["ATTENTION_STOCK", "KY_STOCK", "ONE_PRICE_LIMIT_UP", "EXCESSIVE_CONSECUTIVE_LIMIT_UP", "HIGH_FIVE_DAY_RETURN"]
    assert got[0] == (None, [], ["is_attention", "is_disposition", "is_managed", "consecutive_limit_up_days"], None)
    assert got[1][:3] == (None, every, []) and got[1][3] == pytest.approx(0)
    assert got[2:] == [(None, [], [], 1.0), ("disposition", [], [], 1.0)]


def test_strategy_values(spark, tmp_path):
    s = STRATEGY
    assert (s.version, s.candidates, s.least_turnover, s.published, s.most_pe, s.most_streak, s.hot_return, s.least_completeness) == ("rule-v1.1.0", 50, 50_000_000, 10, 20, 3, 0.35, 0.8)
    assert s.weights == {"liquidity": 0.25, "volume_price": 0.2, "momentum": 0.15, "institutional": 0.15, "fundamental": 0.15, "risk_quality": 0.1}
    assert sum(s.penalties.values()) == pytest.approx(1) and s.penalties["ATTENTION_STOCK"] == 0.15
    two = strategies.DEFAULT.read_text().strip()[1:-1]
    (tmp_path / "s.json").write_text(f"[{two},{two}]")
    with pytest.raises(ValueError, match="twice"):
        strategies.load_strategies(tmp_path / "s.json")


def test_equal_before_drawing_in_scores_fifty(spark):
    rows = [(1, 3.0), (2, None)] + [(3, 5.0)] * 100 + [(3, 9.0)]
    d = spark.createDataFrame(rows, "d int, x double")
    got = {(r.d, r.s and round(r.s, 3)) for r in ranking.percentile_scores(d, {"s": "x"}, ["d"]).collect()}
    # one value apart: all are drawn in to 5, share one rank, and still are no equal values
    assert got == {(1, 50.0), (2, None), (3, 50.495)}


def test_trailing_columns(spark):
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    bars = spark.createDataFrame([("1", day(i), 10.0 + i, 0 if i == 22 else 100, 5.0) for i in range(24)] + [("1", day(24), 0.0, 1, 1.0)], "stock_id string, trading_date date, close double, volume long, turnover double")
    flows = spark.createDataFrame([("1", day(i), 10) for i in range(24) if i != 3] + [("2", day(1), 1), ("2", day(1), 2)], "stock_id string, trading_date date, net_shares long")
    t = spark.createDataFrame([("1", day(25), 50.0, 200, "a"), ("1", day(25), 25.0, 100, "b"), ("1", day(6), 10.0, 1, "c"), ("9", day(6), 1.0, 1, "d"), ("1", day(99), 50.0, 200, "e")], "stock_id string, trading_date date, close double, volume long, bar string")
    got = {r.bar: r for r in factors.point_in_time(t, bars, flows, lookback_days=60).collect()}
    # the session without a close is no history, the one without volume is, but not for flows
    assert got["a"].volume_ratio_20d == pytest.approx(200 / 95) and got["a"].return_5d == pytest.approx(50 / 29 - 1) and got["b"].return_5d == pytest.approx(25 / 29 - 1)
    assert got["a"].net_buy_ratio is None and got["c"].net_buy_ratio is None  # day 24 traded, but has no flow; day 3 has none
    assert got["c"].return_5d == pytest.approx(10 / 11 - 1) and got["c"].average_turnover_20d is None
    assert (got["d"].has_history, got["d"].return_5d) == (False, None) and got["e"].return_5d is None and not got["e"].has_history
    assert factors.point_in_time(t).count() == 5


def test_two_flows_on_a_date_void_the_ratio(spark):
    day = lambda n: datetime.date(2024, 1, n)
    bars = spark.createDataFrame([("1", day(i), 1.0, 10, 1.0) for i in range(1, 9)], "stock_id string, trading_date date, close double, volume long, turnover double")
    flows = spark.createDataFrame([("1", day(i), 5) for i in range(1, 9)] + [("1", day(7), 5)], "stock_id string, trading_date date, net_shares long")
    t = spark.createDataFrame([("1", day(7)), ("1", day(8))], "stock_id string, trading_date date")
    assert {r.trading_date.day: r.net_buy_ratio for r in factors.flow_ratio(t, bars, flows).collect()} == {7: 0.5, 8: None}


def test_revisions_of_revenue(spark):
    day = lambda m, n: datetime.date(2024, m, n)
    rows = [("1", 2024, 1, 300.0, day(2, 10), 0), ("1", 2023, 1, 100.0, day(1, 1), 1), ("1", 2023, 1, 150.0, day(9, 1), 2), ("1", 2023, 1, 200.0, day(9, 1), 3), ("1", 2023, 1, 50.0, None, 4), ("1", 2024, 2, 9.0, None, 5)]
    r = spark.createDataFrame(rows, "stock_id string, revenue_year int, revenue_month int, revenue double, available_at date, ordinal int")
    t = spark.createDataFrame([("1", day(2, 9)), ("1", day(2, 10))], "stock_id string, trading_date date")
    # the year before counts in its latest revision, also one not known yet; of equal ones the first
    assert {x.trading_date.day: x.revenue_yoy for x in factors.revenue_yoy(t, r).collect()} == {9: None, 10: 1.0}


def test_merging_repeated_rows(spark):
    cols = "trading_date int, stock_id string, high double, volume long, has_price_limit boolean, quality boolean, ordinal int"
    p = spark.createDataFrame([(1, "a", 0.0, 5, True, True, 1), (1, "a", None, 0, False, True, 2), (1, "b", 1.0, 1, True, True, 1)], cols)
    f = spark.createDataFrame([(1, "a", 3.0, 7, True, True, 1), (1, "a", 4.0, 8, True, False, 2), (2, "b", 9.0, 9, True, True, 1)], cols)
    got = sorted(tuple(r) for r in monitoring.merge_sources(p, f, ["high", "volume"]).collect())
    assert got == [(1, "a", 4.0, 8, False, False), (1, "b", 1.0, 1, True, True)]


def test_readiness_gates(spark):
    day = lambda n: datetime.date(2024, 1, n)
    spine = spark.createDataFrame([(day(n), n == 3) for n in (2, 3, 4, 5, 6, 8, 9, 10)], "trading_date date, holiday boolean")
    payloads = spark.createDataFrame([(day(4), "TWSE", "prices", True), (day(4), "TPEX", "prices", False), (day(5), "TWSE", "prices", False)], "target_date date, market string, kind string, well_formed boolean")
    rows = spark.createDataFrame([(day(n), m, 2, 0 if n == 9 and m == "TPEX" else 1) for n in (2, 4, 6, 8, 9, 10) for m in ("TWSE", "TPEX") if (n, m) != (8, "TPEX")], "target_date date, market string, on_date long, mapped long")
    values = spark.createDataFrame([("TWSE", day(4)), ("TPEX", day(4)), ("TWSE", day(10))], "market string, snapshot_date date")
    master = spark.range(1)
    got = {r.trading_date.day: r.status for r in monitoring.source_readiness(spine, payloads, rows, values, master).collect()}
    assert got == {2: "WAITING_FOR_DATA", 3: "SKIPPED_NON_TRADING_DAY", 4: "FAILED", 5: "FAILED", 6: "SKIPPED_NON_TRADING_DAY", 8: "WAITING_FOR_DATA", 9: "WAITING_FOR_DATA", 10: "WAITING_FOR_DATA"}
    later = values.unionByName(spark.createDataFrame([("TPEX", day(9))], "market string, snapshot_date date"))
    ready = {r.trading_date.day: r.status for r in monitoring.source_readiness(spine, payloads, rows, later, master).collect()}
    assert ready[10] == "READY" and ready[9] == "WAITING_FOR_DATA"
    status = lambda d, *x: {r.trading_date.day: r.status for r in monitoring.source_readiness(spine, d, rows, *x).collect()}
    assert status(payloads, later, master.limit(0))[10] == "FAILED"
    # rows of the master's source are asked for before mapped rows, the master after them
    assert status(payloads, later, master.limit(0), master.limit(0))[9] == "FAILED" and status(payloads, later, master.limit(0), master)[9] == "WAITING_FOR_DATA"
    # valuations of the wrong form fail the date, though an older snapshot would do
    more = payloads.unionByName(spark.createDataFrame([(day(10), "TPEX", "valuations", False)], payloads.schema))
    assert status(more, later, master)[10] == "FAILED" and status(more, later, master)[9] == "WAITING_FOR_DATA"


def test_report_without_rows_and_orphans(spark):
    day = datetime.date(2024, 1, 2)
    days = spark.createDataFrame([("v", day, 10, 3, 0)], "strategy_version string, trading_date date, published int, n_candidates long, n_eligible long")
    ranked = spark.createDataFrame([("v", day, 1, "2330", " ", 88.125, 0.9, ["momentum", "new"], [], ["KY_STOCK", "NEW"], 11.0, 10.0, True)],
        "strategy_version string, trading_date date, rank int, stock_id string, stock_name string, total_score double, completeness double, top_factors array<string>, missing_factors array<string>, risk_flags array<string>, close double, reference double, one_price boolean")
    none = reports.render_report(days, ranked.limit(0)).first()
    assert reports.NOBODY in none.report and not none.too_long and none.n_units == len(none.report)
    text = reports.render_report(days, ranked).first().report
    for line in ("1. 2330 (2330)", "close 11.00", "change +10.00%", "data 90%", "strong in: Momentum, new", "shape: one price all day", "risk: registered abroad (KY), NEW"):
        assert line in text.split("\n")
    assert "missing" not in text
    assert reports.orphans(ranked, ranked).count() == 0 and reports.orphans(ranked, ranked.where("stock_id = '1'")).count() == 1


EXCHANGE = (
    "日期,證券代號,證券名稱,成交股數,成交金額,開盤價,最高價,最低價,收盤價,漲跌價差,成交筆數\n"
    '"1130305","1234","A ""x"",\nB","1,002,003","30,060,090","29.80","30.50","29.70","30.10","0.4000","17"\r\n'
    '\n"1130305","5678","b","400","5200","13.00","13.10","12.90","13.00","0.0000","3"\n'
    '"1130305","4321","c","7","91","0.00","0.00","0.00","0.00","0.0000","1","extra"\n"1130304","9","","","","","","","","",""\n"1130305"," ","","","","","","","","",""'
)


def test_csv_is_keyed_by_its_header(spark):
    d = spark.createDataFrame([('id,date,id\n"1","2024",",x"\n,,\n5',), ("\ufeffid\n1",), ("id,date",), ("",), (None,)], "payload string")
    assert [r.fields for r in landing.csv_rows(d).collect()] == [{"date": "2024", "id": ",x"}, {"date": "", "id": ""}, {"date": None, "id": None}, {"id": "1"}]


def test_exchange_rows(spark):
    day = datetime.date(2024, 3, 5)
    p = spark.createDataFrame([(day, EXCHANGE)], "target_date date, payload string")
    got = {r.stock_id: r for r in mappers.map_quotes(landing.csv_rows(p), "TWSE").collect()}
    assert set(got) == {"1234", "5678", "4321"}
    assert (got["1234"].reference, got["1234"].volume, got["1234"].turnover, got["1234"].quality) == (Decimal("29.7000"), 1002003, Decimal("30060090.0000"), True)
    assert got["5678"].reference == Decimal("13") and (got["4321"].close, got["4321"].volume, got["4321"].quality) == (None, 7, False)
    assert {(r.target_date, r.on_date, r.mapped, r.market) for r in mappers.reported(landing.csv_rows(p), "TWSE").collect()} == {(day, 4, 3, "TWSE")}
    js = '[{"Date":"1130305","SecuritiesCompanyCode":"8765\u3000","Close":"20.50","Change":"-0.30","Open":"20.60","High":"20.90","Low":"20.40","TradingShares":"100","TransactionAmount":"2050","NextLimitUp":"22.55"}, 3]'
    q = spark.createDataFrame([(day, js)], "target_date date, payload string")
    r = mappers.map_quotes(landing.json_rows(q), "TPEX").first()
    assert (r.stock_id, r.reference, r.limit_up_price, r.quality) == ("8765", Decimal("20.80"), None, True)
    assert [x.ok for x in spark.createDataFrame([("[1]",), (' [{"a":1}]',), ("{}",), ("[",), (None,)], "p string").select(landing.is_json_array(F.col("p")).alias("ok")).collect()] == [True, True, False, False, False]


def fields(spark, rows):
    return spark.createDataFrame([(i, {k: v for k, v in r.items()}) for i, r in enumerate(rows)], "ordinal int, fields map<string,string>")


def test_provider_rows(spark):
    info = fields(spark, [{"stock_id": "1", "type": "twse", "stock_name": "old"}, {"stock_id": " 1 ", "type": " TPEX", "stock_name": "", "industry_category": "存託憑證"}, {"stock_id": "2330", "type": "twse", "industry_category": "warrant"}, {"stock_id": "3", "type": "emerging"}, {"stock_id": " ", "type": "twse"}, {"stock_id": "4", "type": "twse", "stock_name": "權證"}])
    got = {r.stock_id: (r.stock_name, r.market, r.security_type, r.industry, r.attention) for r in mappers.stock_master(info).collect()}
    assert got == {"1": ("1", "TPEX", "DR", "存託憑證", None), "2330": ("2330", "TWSE", "COMMON_STOCK", "warrant", None), "4": ("權證", "TWSE", "WARRANT", None, None)}
    bar = {"stock_id": "1", "date": "2024-01-02", "close": "5", "Trading_Volume": "0", "Trading_money": "1.5"}
    h = fields(spark, [bar, bar | {"close": "0"}, bar | {"close": "N/A"}, bar | {"date": "2024-1-2"}, bar | {"Trading_Volume": "1.5"}, bar | {"stock_id": ""}, bar | {"close": "1,000"}])
    assert [(r.close, r.volume, r.turnover) for r in mappers.map_history(h).collect()] == [(5.0, 0.0, 1.5)]
    row = {"stock_id": "1", "revenue_year": "2024", "revenue_month": "2", "revenue": "7", "create_time": "2024-03-10 09:00:00"}
    r = fields(spark, [row, row | {"create_time": ""}, row | {"create_time": "soon"}, row | {"revenue_month": "13"}, row | {"revenue": "-1"}, row | {"revenue": "1.5"}, row | {"revenue_year": "0"}])
    assert [str(x.available_at) for x in mappers.map_revenue(r).orderBy("ordinal").collect()] == ["2024-03-10", "None"]
    v = fields(spark, [{"Date": "1130105", "Code": "1", "PEratio": "-"}, {"Date": "1130105", "Code": "2", "PEratio": "-5.1"}, {"Date": "x", "Code": "3", "PEratio": "1"}, {"Date": "1130105", "Code": " ", "PEratio": "1"}])
    assert [(x.stock_id, x.pe_ratio) for x in mappers.map_valuations(v, "TWSE").orderBy("stock_id").collect()] == [("1", None), ("2", Decimal("-5.1000"))]


def test_reference_is_the_close_of_the_session_before(spark):
    row = lambda d, c, s="1": {"stock_id": s, "date": d, "close": c, "max": c, "Trading_Volume": "1", "Trading_money": "1"}
    rows = fields(spark, [row("2024-01-02", "5"), row("2024-01-03", "6"), row("2024-01-03", "7"), row("2024-01-03", "0"), row("2024-01-05", "8"), row("2024-01-05", "9", "2")])
    days = mappers.session_calendar(spark.createDataFrame([(datetime.date(2024, 1, n),) for n in (2, 3, 5, 5)], "trading_date date"))
    got = {(r.stock_id, str(r.trading_date)[-2:], r.close): r.reference for r in mappers.map_prices_prev_close(rows, "TWSE", days).collect()}
    assert got == {("1", "02", 5): None, ("1", "03", 6): 5, ("1", "03", 7): 5, ("1", "03", None): 5, ("1", "05", 8): 7, ("2", "05", 9): None}


def test_snapshots_as_of(spark):
    day = lambda n: datetime.date(2024, 1, n)
    v = spark.createDataFrame([("TWSE", day(4), "a", 5.0), ("TWSE", day(5), "b", 6.0), ("TPEX", day(5), "b", 7.0), ("TPEX", day(5), "c", -1.0)], "market string, snapshot_date date, stock_id string, pe_ratio double")
    dates = spark.createDataFrame([(day(4),), (day(6),), (day(11),)], "trading_date date")
    got = sorted((r.trading_date.day, r.stock_id, r.pe_ratio) for r in factors.valuation_snapshots(dates, v).collect())
    assert got == [(6, "b", 7.0), (6, "c", -1.0)]


def test_rows_are_written_once_per_key(spark, tmp_path):
    d = spark.createDataFrame([("v", "2024-01-02", "a", 1), ("v", "2024-01-02", "a", 2), ("v", "2024-01-03", "a", 3)], "strategy_version string, trading_date string, stock_id string, x int")
    landing.write_by_date(d, str(tmp_path / "t"))
    landing.write_by_date(d.where("x = 3").withColumn("x", F.lit(9)), str(tmp_path / "t"))
    assert sorted(r.x for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [2, 9]


def test_json_rows_drop_what_is_no_object(spark):
    d = spark.createDataFrame([('[{"a":"1"},7,"x",{"a":"2"}]',), ("{}",), (None,)], "payload string")
    assert [r.fields["a"] for r in landing.json_rows(d).collect()] == ["1", "2"]
    e = spark.createDataFrame([('{"data":[{"a":"1"}]}',), ("[]",)], "payload string")
    assert landing.envelope_rows(e).count() == 1


def test_landing_twice_adds_nothing(spark, tmp_path):
    p = spark.createDataFrame([("r", "s", "k", "2024-01-01", '{"b":1,"a":2}', {"token": "x", "q": "1"})], "run_id string, source string, request_key string, target_date string, payload string, parameters map<string,string>")
    for _ in range(2):
        landing.append_snapshots(p.unionByName(p), str(tmp_path / "raw"))
    rows = spark.read.parquet(str(tmp_path / "raw")).collect()
    assert len(rows) == 1 and rows[0].parameters == {"q": "1"}
    assert rows[0].payload_hash == hashlib.sha256(b'{"a": 2, "b": 1}').hexdigest()


def test_publication_states(spark):
    m = spark.createDataFrame([("1", "t"), ("2", "t"), ("3", "t"), ("4", "t")], "key string, text string")
    h = one(spark, F.sha2(F.lit("t"), 256))
    done = spark.createDataFrame([("2", h, "SUCCESS"), ("3", h, "FAILED"), ("4", "other", "SUCCESS")], "key string, hash string, status string")
    assert {r.key: r.action for r in delivery.publish_once(m, done).collect()} == {"1": "insert", "2": "skip", "3": "retry", "4": "conflict"}


def test_two_reruns_reserve_once(spark, tmp_path):
    path, at = str(tmp_path / "ledger"), lambda n: F.lit(f"2024-01-02 00:00:{n:02}")
    m = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", "y", 3), ("b", "z", 4), (None, "n", 5)], "key string, text string, ordinal int")
    act = lambda d: sorted((r.ordinal, r.action) for r in d.collect())
    first = delivery.reserve(m, path, at(1))
    want = [(1, "insert"), (2, "repeat"), (3, "conflict"), (4, "insert"), (5, "invalid")]
    assert act(first) == want  # also after the reservations have been written
    keys = {r.key: r.retry_key for r in first.where("action = 'insert'").collect()}
    again = delivery.reserve(m, path, at(2))
    assert act(again) == [(1, "retry"), (2, "repeat"), (3, "conflict"), (4, "retry"), (5, "invalid")]
    assert {r.key: r.retry_key for r in again.where("action = 'retry'").collect()} == keys and len(set(keys.values())) == 2
    sent = spark.createDataFrame([("a", 1, False, None, "down"), ("b", 1, True, "id", None)], "key string, attempt int, ok boolean, request_id string, error string")
    delivery.outcomes(sent, at(3)).write.mode("append").parquet(path)
    state = lambda: {r.key: (r.status, r.attempts, r.error, r.request_id) for r in delivery.ledger_state(delivery.read_ledger(spark, path)).collect()}
    assert state() == {"a": ("FAILED", 1, "down", None), "b": ("SUCCESS", 0, None, "id")}
    late = spark.createDataFrame([("a", 2, True, "id2", None), ("b", 2, False, None, "late"), ("c", 1, True, "x", None)], sent.schema)
    delivery.outcomes(late, at(4)).write.mode("append").parquet(path)
    assert state() == {"a": ("SUCCESS", 1, None, "id2"), "b": ("SUCCESS", 0, None, "id")}
    assert act(delivery.reserve(m, path, at(5))) == [(1, "skip"), (2, "skip"), (3, "conflict"), (4, "skip"), (5, "invalid")]
    assert delivery.read_ledger(spark, path).where("kind = 'RESERVED'").count() == 2


@pytest.mark.parametrize("space", ["\t", "\n", "\u3000", "\xa0", "\x1f", " \u2009"])
def test_white_space_of_any_kind(spark, space):
    t = lambda x: F.lit(f"{space}{x}{space}")
    assert one(spark, parsing.roc_to_date(t("1130229"))) == datetime.date(2024, 2, 29)
    assert one(spark, parsing.parse_decimal(t("5"))) == Decimal(5) and one(spark, parsing.parse_int(t("5"))) == 5
    assert one(spark, parsing.market_of(t("twse"))) == "TWSE" and one(spark, ticks.is_ky(t("x-ky")))
    assert one(spark, parsing.classify_security(F.lit("1234"), F.lit("x"), t("DR"))) == "DR"
    assert one(spark, parsing.iso_to_date(F.lit("2024-01-02\n"))) is None


def test_a_name_of_white_space_stays_empty(spark):
    info = fields(spark, [{"stock_id": "1", "type": "twse", "stock_name": " \t"}, {"stock_id": "2", "type": "twse", "stock_name": ""}, {"stock_id": "3", "type": "twse"}])
    assert {r.stock_id: r.stock_name for r in mappers.stock_master(info).collect()} == {"1": "", "2": "2", "3": "3"}


def test_a_fallback_row_counts_even_where_it_is_null(spark):
    cols = "trading_date int, stock_id string, high double, quality boolean"
    p = spark.createDataFrame([(1, "a", 0.0, True), (1, "b", 0.0, True), (1, "c", 2.0, True)], cols)
    f = spark.createDataFrame([(1, "a", None, True), (1, "c", None, True)], cols)
    assert {r.stock_id: r.high for r in monitoring.merge_sources(p, f, ["high"]).collect()} == {"a": None, "b": 0.0, "c": 2.0}


def test_what_is_out_of_the_look_back_counts_for_nothing(spark):
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    bars = spark.createDataFrame([("1", day(i), 1.0, 10, 1.0) for i in [0, *range(395, 401)]] + [("2", day(0), 1.0, 10, 1.0)], "stock_id string, trading_date date, close double, volume long, turnover double")
    flows = spark.createDataFrame([("1", day(i), 5) for i in range(395, 401)] + [("1", day(80), 5)] * 2, "stock_id string, trading_date date, net_shares long")
    t = spark.createDataFrame([("1", day(401)), ("2", day(196))], "stock_id string, trading_date date")
    got = {r.stock_id: r for r in factors.point_in_time(t, bars, flows, lookback_days=60).collect()}
    assert got["1"].net_buy_ratio == 0.5 and got["1"].has_history and not got["2"].has_history
    assert {r.net_buy_ratio for r in factors.point_in_time(t, bars, flows).collect()} == {None}


def test_revenue_leaves_when_it_is_too_old(spark):
    day = lambda n: datetime.date(2022, 1, 1) + datetime.timedelta(n)
    rows = [("1", 2021, 1, 100.0, None, day(0)), ("1", 2022, 1, 150.0, day(400), day(380)), ("1", 2021, 12, 80.0, day(10), day(5)), ("1", 2020, 12, 40.0, day(700), day(5))]
    r = spark.createDataFrame(rows, "stock_id string, revenue_year int, revenue_month int, revenue double, available_at date, row_date date")
    t = spark.createDataFrame([("1", day(n)) for n in (9, 10, 399, 400, 550, 551, 930, 931)], "stock_id string, trading_date date")
    want = {9: None, 10: 1.0, 399: 1.0, 400: 0.5, 550: 0.5, 551: None, 930: None, 931: None}
    assert {(x.trading_date - day(0)).days: x.revenue_yoy for x in factors.revenue_yoy(t, r, 550).collect()} == want


def test_revenue_against_brute_force(spark):
    import random

    chance, day = random.Random(3), lambda n: datetime.date(2020, 1, 1) + datetime.timedelta(n)
    rows = sorted({(chance.choice("ab"), y, m, a): (chance.choice("ab"), y, m, float(chance.randrange(0, 50)), a and day(a), day(10 * (12 * (y - 2020) + m) + chance.randrange(20)), i) for i in range(150)
                   for y, m, a in [(chance.randrange(2020, 2023), chance.randrange(1, 4), chance.choice([None, chance.randrange(500)]))]}.values(), key=str)
    rows = list({(r[0], r[1], r[2], r[4]): r for r in rows}.values())
    r = spark.createDataFrame(rows, "stock_id string, revenue_year int, revenue_month int, revenue double, available_at date, row_date date, ordinal int")
    targets = [(s, day(n)) for s in "abc" for n in range(0, 700, 9)]
    got = {(x.stock_id, x.trading_date): x.revenue_yoy for x in factors.revenue_yoy(spark.createDataFrame(targets, "stock_id string, trading_date date"), r, 200).collect()}

    def want(s, t):
        here = [x for x in rows if x[0] == s and 1 <= (t - x[5]).days <= 200]
        known = [x for x in here if x[4] and x[4] <= t]
        if not known:
            return None
        now = max(known, key=lambda x: (x[1], x[2], x[4]))
        prior = [x for x in here if (x[1], x[2]) == (now[1] - 1, now[2])]
        before = max(prior, key=lambda x: x[4] or datetime.date.min)[3] if prior else 0
        return now[3] / before - 1 if before > 0 else None

    assert got == {k: want(*k) for k in targets} and sum(x is not None for x in got.values()) >= 3


def test_histories_of_many_targets(spark):
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    rows = spark.createDataFrame([(s, day(i)) for s in "ab" for i in range(120)], "stock_id string, trading_date date")
    targets = [("a", 10), ("a", 12), ("a", 70), ("a", 75), ("b", 0), ("c", 5)]
    t = spark.createDataFrame([(s, day(n)) for s, n in targets] + [("b", None)], "stock_id string, trading_date date")
    assert sorted((r.stock_id, (r.first - day(0)).days, (r.last - day(0)).days) for r in landing.history_ranges(t, 5).collect()) == [("a", 5, 11), ("a", 65, 74), ("b", -5, -1), ("c", 0, 4)]
    want = sorted({(s, i) for s, n in targets for i in range(n - 5, n) if s in "ab" and i >= 0})
    by_month = rows.withColumn("month", F.trunc("trading_date", "MM"))
    for got in (landing.history_panel(rows, t, 5), landing.history_panel(by_month, t, 5, month="month")):
        assert sorted((r.stock_id, (r.trading_date - day(0)).days) for r in got.collect()) == want
    with pytest.raises(Exception, match="no stock_id"):
        landing.history_panel(rows, spark.createDataFrame([("\u3000", day(3))], t.schema), 5).collect()
    with pytest.raises(ValueError, match="one day"):
        landing.history_ranges(t, 0)


def test_the_latest_run_that_ended_well_is_read(spark, tmp_path):
    day = datetime.date(2024, 1, 2)
    p = spark.createDataFrame(
        [("r1", "s", "a", day, "old"), ("r1", "s", "b", day, "only"), ("r2", "s", "a", day, "new"), ("r3", "s", "a", day, "failed"), ("r4", "s", "a", day, "running"), ("r1", "t", None, day, "none")],
        "run_id string, source string, request_key string, target_date date, payload string").withColumn("parameters", F.create_map(F.lit("q"), F.lit("1")))
    landing.append_snapshots(p, str(tmp_path / "raw"))
    at = lambda n: datetime.datetime(2024, 1, 2, n)
    runs = spark.createDataFrame([("r1", at(1), "SUCCESS"), ("r2", at(2), "SUCCESS"), ("r3", at(3), "FAILED"), ("r4", None, "SUCCESS")], "run_id string, finished_at timestamp, status string")
    raw = spark.read.parquet(str(tmp_path / "raw"))
    for most in (0, 100):
        got = lambda **x: sorted(r.payload for r in landing.current_payloads(raw, runs, WorkTables(spark), most_keys=most, **x).collect())  # noqa: B023, E731
        assert got() == ["new", "none", "only"]
        assert got(as_of=F.lit("2024-01-02 01:30:00").cast("timestamp")) == ["none", "old", "only"]
        assert got(as_of=F.lit("2024-01-01").cast("timestamp")) == []
    plan = landing.current_payloads(raw, runs, WorkTables(spark))._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "SortMergeJoin" not in plan


def test_flows_of_two_payloads_count_once(spark):
    day = datetime.date(2024, 1, 2)
    rows = spark.createDataFrame([("1", day, 5, 2, 1), ("1", day, 4, 1, 1), ("1", day, 9, 2, 2), ("1", day, 4, 1, 2), ("2", day, None, 1, 1), ("2", day, 3, 1, 2)], "stock_id string, trading_date date, buy long, sell long, landed int")
    assert sorted((r.stock_id, r.net_shares) for r in factors.institutional_flows(rows).collect()) == [("1", 10), ("2", 2)]


def test_spans_of_an_asof_join_change_nothing(spark):
    day = lambda n: datetime.date(1969, 12, 20) + datetime.timedelta(n)
    left = spark.createDataFrame([(k, day(n), n) for k in ("a", "b", None) for n in range(0, 90, 2)] + [("a", day(4), 99), ("a", None, 7)], "k string, d date, n int")
    right = spark.createDataFrame([(k, day(n), n) for k in ("a", None) for n in (3, 4, 5, 40, 41, 80)] + [("a", None, 1)], "k string, d date, v int")
    for how in ({}, {"strict": True}, {"tolerance_days": 9}, {"strict": True, "tolerance_days": 20}):
        rows = [sorted(map(str, asof.asof_join(left, right, ["k"], "d", bucket_days=b, **how).select("k", "n", "match.v").collect())) for b in (None, 1, 7, 1000)]
        assert rows[0] == rows[1] == rows[2] == rows[3]
    with pytest.raises(ValueError, match="one day"):
        asof.asof_join(left, right, ["k"], "d", bucket_days=-1)


def test_ranks_by_ranges_are_the_ranks_of_windows(spark):
    d = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 7).alias("day"), F.when(F.col("id") % 4 == 0, 5.0).when(F.col("id") % 5 == 0, None).otherwise(F.crc32(F.col("id").cast("string")) % 500).cast("double").alias("a"),
        F.lit(2.0).alias("b"), F.when(F.col("id") == 0, 1.0).alias("c"), "id").repartition(5)
    names = {"x": "a", "y": "b", "z": "c", "w": "a"}
    got = [{r.id: tuple(v and round(v, 9) for v in (r.x, r.y, r.z, r.w)) for r in df.collect()} for df in (ranking.percentile_scores(d, names, ["day"], ["w"]), ranking.percentile_scores_by_ranges(d, names, ["day"], WorkTables(spark), ["w"]))]
    assert len(got[0]) == 3000 and got[0] == got[1]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ranking.value_ranks(d, names, ["day"], WorkTables(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Window" not in plan  # the ranges are windowed before, in what has been written


def test_broken_stages_stop_the_job(spark):
    day = datetime.date(2024, 1, 2)
    c = spark.createDataFrame([("v", day, "1", 5.0, 3, 2.0), ("v", day, "2", None, 3, 2.0)], "strategy_version string, trading_date date, stock_id string, close double, volume long, turnover double")
    assert ranking.checked_candidates(c.where("stock_id = '1'")).count() == 1
    with pytest.raises(Exception, match="lacks close, volume or turnover: 2"):
        ranking.checked_candidates(c).select("stock_id").collect()
    with pytest.raises(Exception, match="no candidate: 2"):
        reports.checked(c, c.where("stock_id = '1'")).select("stock_id").collect()
    assert reports.checked(c, c).columns == c.columns


def test_a_report_that_is_too_long_never_goes_out(spark):
    texts = spark.createDataFrame([("v", datetime.date(2024, 1, n), f"t{n}", n == 3) for n in (2, 3)], "strategy_version string, trading_date date, report string, too_long boolean")
    assert [r.text for r in jobs.messages(texts, "desk").collect()] == ["t2"]


def test_a_failed_assessment_excludes(spark):
    rows = spark.createDataFrame([(True, True, False, 1, 0.1, "x", False, "down"), (False, False, False, 1, 0.1, "x", False, None)], RISK + ", risk_error string")
    d = ranking.assess_risk(strategies.for_each_strategy(rows, [STRATEGY])).withColumns({k: F.lit(None).cast("double") for k in ("net_buy_ratio", "revenue_yoy")} | {"has_history": F.lit(True), "trading_date": F.lit(1)})
    c = monitoring.enrichment_coverage(monitoring.enrichment_states(d)).first()
    assert [r.exclusion for r in d.collect()] == ["risk_failed", None] and (c.risk_failed, c.excluded, c.clean) == (1, 0, 1)


def test_only_missing_dates_are_written(spark, tmp_path):
    path, day = str(tmp_path / "t"), lambda n: datetime.date(2024, 1, n)
    spine = spark.createDataFrame([(day(n), False) for n in (2, 3, 4)], "trading_date date, holiday boolean")
    cols = ", ".join(f"{c} string" for c in jobs.RANKED_COLUMNS).replace("trading_date string", "trading_date date")
    ranked = lambda *days: spark.createDataFrame([tuple(n if c == "trading_date" else "x" for c in jobs.RANKED_COLUMNS) for n in days], cols)
    assert jobs.missing_dates(spine, path).count() == 3
    jobs.publish_rankings(ranked(day(2)), path)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    assert sorted(r.trading_date.day for r in jobs.missing_dates(spine, path).collect()) == [3, 4]
    jobs.publish_rankings(ranked(day(3)), path)
    assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in before.items()) and len(list((tmp_path / "t").rglob("*.parquet"))) == 2
