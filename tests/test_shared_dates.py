"""Several bars of a stock on one date, which users of five digits lead to: sessions of prices, volumes of flows, payloads and rounding."""

import datetime
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

from limitrank.operators import factors
from limitrank.plans import fixtures, queries
from test_cut_ids import _events

DAY = [datetime.date(2024, 1, n) for n in range(1, 32)]
BAR = "stock_id string, trading_date date, close double, volume long, turnover double, ordinal int"


def test_bars_of_one_date_are_a_session_each(spark):
    rows = [("1", DAY[i // 2], 100.0 + i, 10 + i, float(i * i), i) for i in range(24)]
    t = spark.createDataFrame([("1", DAY[12], 50.0, 30), ("1", DAY[3], 50.0, 30)], "stock_id string, trading_date date, close double, volume long")
    late, early = factors.price_features(t, spark.createDataFrame(rows[::-1], BAR)).orderBy(F.desc("trading_date")).collect()
    assert late.average_turnover_20d == pytest.approx(sum(i * i for i in range(4, 24)) / 20) and late.volume_ratio_20d == pytest.approx(30 / (10 + sum(range(4, 24)) / 20))
    assert late.return_5d == pytest.approx(50 / 119 - 1) and late.return_20d == pytest.approx(50 / 104 - 1)
    # six bars lie before the fourth date; its own do not count
    assert early.return_5d == pytest.approx(50 / 101 - 1) and early.average_turnover_20d is None


def test_only_bars_of_a_dates_last_payload_are_sessions(spark):
    rows = [("1", DAY[i], 10.0 * landed + i, 5, 1.0, 0, landed) for i in range(6) for landed in (1, 2)]
    t = spark.createDataFrame([("1", DAY[8], 50.0, 30)], "stock_id string, trading_date date, close double, volume long")
    assert factors.price_features(t, spark.createDataFrame(rows, BAR + ", landed int")).first().return_5d == pytest.approx(50 / 21 - 1)


def test_a_target_with_several_bars_is_one_row_and_flows_take_the_last_volume(spark):
    rows = [("1", DAY[i], 1.0 / (n + 1), 10 * (n + 1), 1.0, n) for i in range(7) for n in range(3)]
    flows = spark.createDataFrame([("1", d, 6) for d in DAY[:7]], "stock_id string, trading_date date, net_shares long")
    t = spark.createDataFrame([("1", d) for d in DAY[:7]], "stock_id string, trading_date date")
    got = sorted(map(tuple, factors.flow_ratio(t, spark.createDataFrame(rows, BAR), flows).collect()))
    assert got == [("1", d, 0.2 if i >= 5 else None) for i, d in enumerate(DAY[:7])]


#: Bars in the order of users; the SQL leaves it open and takes any of those on one date.
PRICES = queries.HISTORY.strip().replace("ORDER BY trading_date", "ORDER BY trading_date, user_id").replace("FROM h0)", "FROM h0 QUALIFY row_number() OVER (PARTITION BY stock_id, trading_date ORDER BY user_id DESC) = 1)")
#: The reference keeps one volume of a date, that of the last bar.
RATIOS = queries.FLOWS.strip().replace("FROM bars b LEFT", "FROM (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY stock_id, trading_date ORDER BY user_id DESC) = 1) b LEFT")


@pytest.mark.parametrize("name,old,new", [("price_features", queries.HISTORY.strip(), PRICES), ("flow_ratio", queries.FLOWS.strip(), RATIOS)])
def test_shared_ids_match_sql_with_its_ties_closed(spark, tmp_path, name, old, new):
    path = _events(spark, tmp_path)
    got = queries.QUERIES[name](spark, path)
    con = duckdb.connect()
    con.execute(f"create view events as select * replace (cast(ts as timestamp) as ts) from '{path}/events.parquet/*.parquet'")
    assert old != new and old in queries.SQL[name]
    want = con.execute(f"select {', '.join(got.columns)} from ({queries.SQL[name].replace(old, new)})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and any(r[2] is not None for r in want)


def test_history_payloads_hold_bars_of_a_shared_id_by_user(spark, data, tmp_path):
    path = _events(spark, tmp_path)
    for name in ("orders", "customer"):
        shutil.copy(f"{data}/{name}.parquet", path)
    rows = fixtures.landing.envelope_rows(fixtures.raw_sources(spark, path).where("source = 'history'")).where("fields['stock_id'] = '1000' and fields['date'] = '2024-01-03'")
    want = fixtures.daily_bars(spark, path).where("stock_id = '1000' and trading_date = '2024-01-03'").orderBy("user_id")
    assert [float(r.c) for r in rows.orderBy("ordinal").select(F.expr("fields['close']").alias("c")).collect()] == [r.close for r in want.collect()]


def test_shown_numbers_are_rounded_as_sql_rounds_them(spark):
    d = spark.createDataFrame([(1297 / 640,), (0.1296875,), (None,)], "x double")
    assert [r.x for r in queries.doubles(d).collect()] == [duckdb.execute("select round(?::double, 6)", [v]).fetchone()[0] for v in (1297 / 640, 0.1296875, None)] == [2.026562, 0.129688, None]
