"""The daily list for every date and strategy at once, from landed payloads to published texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import delivery, factors, monitoring, ranking, reports
from ..sources import landing, mappers
from ..sources.strategies import Strategy, for_each_strategy
from ..sources.work import WorkTables

#: Calendar days of history and of revenue rows behind a factor (fixed values).
LOOKBACK_DAYS, REVENUE_DAYS = 60, 550


def mapped_sources(payloads: DataFrame, work: WorkTables) -> dict[str, DataFrame]:
    """Typed tables of the payloads of one choice of runs (see ``landing.current_payloads``).

    ``payloads`` has source, target_date and payload: prices_twse (CSV), prices_tpex, valuations_twse and valuations_tpex (JSON arrays); info, history,
    flows and revenue ({"data": [...]}). Prices, valuations and the master, which several stages read, are written to ``work``.
    """
    def of(source: str) -> DataFrame:
        return payloads.where(F.col("source") == source)

    arrays = ("prices_tpex", "valuations_twse", "valuations_tpex")
    form = F.when(F.col("source").isin(*arrays), landing.is_json_array(F.col("payload"))).otherwise(F.col("payload").isNotNull())
    kind, market = F.split_part("source", F.lit("_"), F.lit(1)), F.upper(F.split_part("source", F.lit("_"), F.lit(2)))
    forms = payloads.where(F.col("source").isin("prices_twse", *arrays)).select("target_date", market.alias("market"), kind.alias("kind"), form.alias("well_formed"))
    info = landing.envelope_rows(of("info"))
    read = mappers.read_quotes(landing.csv_rows(of("prices_twse")), "TWSE").unionByName(mappers.read_quotes(landing.json_rows(of("prices_tpex")), "TPEX"))
    values = mappers.map_valuations(landing.json_rows(of("valuations_twse")), "TWSE").unionByName(mappers.map_valuations(landing.json_rows(of("valuations_tpex")), "TPEX"))
    kept = work.write_all({"quotes": read, "valuations": values, "master": mappers.stock_master(info), "forms": forms})
    return {
        "prices": mappers.quotes_of(kept["quotes"]), "payloads": kept["forms"], "reported": mappers.reports_of(kept["quotes"]), "valuations": kept["valuations"], "master": kept["master"], "info": info,
        "bars": mappers.map_history(landing.envelope_rows(of("history"))), "flows": factors.institutional_flows(mappers.map_flows(landing.envelope_rows(of("flows")))),
        "revenue": mappers.map_revenue(landing.envelope_rows(of("revenue"))),
    }


def unknown_streak(rows: DataFrame) -> DataFrame:
    return rows.withColumn("streak", F.lit(None).cast("int"))


def daily_ranking(
    landed: DataFrame, runs: DataFrame, spine: DataFrame, strategies: Sequence[Strategy], work: WorkTables,
    risk: Callable[[DataFrame], DataFrame] = unknown_streak, as_of: Column | None = None,
) -> dict[str, DataFrame]:
    """All stages by name: readiness, mapped, candidates (cut before the P/E rule), eligible, featured, scored, complete, ranked, reports.

    ``landed`` and ``runs`` are what ``landing`` wrote; of each request the payload of the latest run that ended well counts (before ``as_of``, if given), so
    a rerun of a day changes nothing but what it fetched anew. ``spine`` has trading_date and holiday. ``risk`` adds what is known of attention,
    disposition, managed, streak and risk_error. Dates that are not READY are left out of all stages after ``readiness``.

    What several stages read is written once to ``work``; drop it when the results have been used. Histories are cut to what lies before the stocks that
    closed at their limit, before any window runs. Candidates without close, volume or turnover and ranked rows that are no candidates stop the job.
    """
    s = mapped_sources(landing.current_payloads(landed, runs, work, as_of), work)
    readiness = work.write(monitoring.source_readiness(spine, s["payloads"], s["reported"], s["valuations"], s["master"], s["info"]), "readiness")
    ready = readiness.where("status = 'READY'").select("trading_date")
    # one row per ready date, so never large
    mapped = s["prices"].join(F.broadcast(ready), "trading_date", "left_semi")
    limit_up = work.write(ranking.limit_up_stocks(mapped, s["master"]), "limit_up")
    keys = limit_up.select("stock_id", "trading_date")
    past = {k: landing.history_panel(s[k], keys, LOOKBACK_DAYS) for k in ("bars", "flows")} | {"revenue": landing.history_panel(s["revenue"], keys, REVENUE_DAYS, "row_date")}
    closed = work.write(factors.point_in_time(limit_up, **past, lookback_days=LOOKBACK_DAYS, revenue_days=REVENUE_DAYS), "closed")
    candidates = ranking.checked_candidates(ranking.cut_candidates(for_each_strategy(closed, strategies)))
    eligible = factors.filter_by_pe(candidates, factors.valuation_snapshots(ready, s["valuations"]), F.col("strategy.most_pe"))
    featured = monitoring.enrichment_states(ranking.assess_risk(risk(eligible)))
    scored = work.write(ranking.score(featured.where(F.col("exclusion").isNull())), "scored")
    complete = ranking.complete_enough(scored)
    ranked = ranking.factor_lists(reports.checked(ranking.select_top_n(scored), candidates))
    days = for_each_strategy(ready, strategies).select("strategy_version", "trading_date", F.col("strategy.published").cast("int").alias("published"))
    counts = [df.groupBy(*ranking.CROSS).agg(F.count(F.lit(1)).alias(n)) for n, df in (("n_candidates", candidates), ("n_eligible", complete))]
    days = days.join(counts[0], ranking.CROSS, "left").join(counts[1], ranking.CROSS, "left").na.fill(0, ["n_candidates", "n_eligible"])
    return {
        "readiness": readiness, "mapped": mapped, "candidates": candidates, "eligible": eligible, "featured": featured, "scored": scored,
        "complete": complete, "ranked": ranked, "reports": reports.render_report(days, ranked),
    }


def messages(texts: DataFrame, target: str, message_version: str = "text-v4") -> DataFrame:
    """Texts of ``daily_ranking`` as messages for ``delivery.publish_once``: key and text, for one receiver. A report that is too long never goes out."""
    key = delivery.delivery_key(F.col("trading_date"), F.col("strategy_version"), F.lit(target), F.lit(message_version))
    return texts.where(~F.col("too_long")).select("strategy_version", "trading_date", key.alias("key"), F.col("report").alias("text"))


RANKED_COLUMNS = ["strategy_version", "trading_date", "rank", "stock_id", "stock_name", "close", "total_score", "completeness", "factor_scores", "top_factors", "missing_factors", "risk_flags"]


def missing_dates(spine: DataFrame, path: str) -> DataFrame:
    """Dates of ``spine`` that the table of rankings at ``path`` has no folder for; only folder names are read."""
    spark = spine.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spine
    return spine.join(spark.read.parquet(path).select(F.col("trading_date").cast("date")).distinct(), "trading_date", "left_anti")


def publish_rankings(ranked: DataFrame, path: str) -> None:
    """Write ranked rows to ``path`` by strategy and date; the folders of these are replaced and no others."""
    landing.write_by_date(ranked.select(*RANKED_COLUMNS), path, unique=("stock_id",))
