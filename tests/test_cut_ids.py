"""Users of five digits, whose stock ids are cut to four, so that several users share an id and a date."""

import datetime

import duckdb
from pyspark.sql import functions as F

from limitrank.plans import fixtures, queries


def _events(spark, path):
    """Users 1000 and 10000 to 10003 on nine days, of both markets, with prices on both sides of the P/E rule."""
    rows = []
    for i, user in enumerate((1000, 10000, 10001, 10002, 10003, 2002, 2003)):
        for day in range(1, 10):
            for n in range(2):
                rows.append((len(rows), datetime.datetime(2024, 1, day, 9 + n, i), user, ("purchase", "error")[n], float((i * 83 + day * 17) % 400 + 20), '{"k": %d}' % (i * 7 + day + n)))
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


def _sql(path, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * replace (cast(ts as timestamp) as ts) from '{path}/events.parquet/*.parquet'")
    return sorted(con.execute(queries.SQL[name]).fetchall())


def test_any_valuation_of_a_shared_id_counts(spark, tmp_path):
    path = _events(spark, tmp_path)
    got = sorted(tuple(r) for r in queries.QUERIES["valuation_filter"](spark, path).select("stock_id", "trading_date").collect())
    want = _sql(path, "valuation_filter")
    assert got == want and len({r[0] for r in want}) > 1


def test_quotes_of_a_shared_id_do_not_depend_on_the_order_of_bars(spark, tmp_path):
    bars = fixtures.daily_bars(spark, _events(spark, tmp_path))
    got = [sorted(map(tuple, fixtures.quotes(bars.orderBy(order).coalesce(1)).drop("has_price_limit").select("stock_id", "trading_date", "volume", "turnover", "reference", "close").collect()), key=str) for order in (F.asc("user_id"), F.desc("user_id"))]
    assert got[0] == got[1] and len(got[0]) == 63
