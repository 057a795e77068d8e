"""Deterministic report texts, one for each strategy and date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import strip, utf16_length
from ..functions.ticks import change_percent
from .ranking import CROSS

LABELS = {"liquidity": "Liquidity", "volume_price": "Price and volume", "momentum": "Momentum", "institutional": "Institutional flows", "fundamental": "Fundamentals", "risk_quality": "Risk quality"}
FLAGS = {
    "ATTENTION_STOCK": "on the attention list", "KY_STOCK": "registered abroad (KY)", "ONE_PRICE_LIMIT_UP": "traded at the limit only, so hard to follow",
    "EXCESSIVE_CONSECUTIVE_LIMIT_UP": "many limit-up days in a row", "HIGH_FIVE_DAY_RETURN": "steep rise over five sessions",
}
REASONS = {
    "liquidity": "liquidity (no volume or turnover)", "volume_price": "price and volume (history too short)", "momentum": "momentum (no recent return)",
    "institutional": "institutional flows (incomplete)", "fundamental": "fundamentals (no monthly revenue)", "risk_quality": "risk quality (state of the stock unknown)",
}
NO_FLAG = "closed at its limit; opening lower and wide swings are likely"
CLOSING = "Scores weigh the factors of strategy {} to order the candidates; they forecast no return, probability or target price. For research only; no advice."
NOBODY = "No candidate is complete enough today."
#: Longest message in UTF-16 units (fixed value).
LONGEST = 5000


def _shown(names: Column, labels: dict[str, str]) -> Column:
    known = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.transform(names, lambda k: F.coalesce(known[k], k))


def orphans(ranked: DataFrame, candidates: DataFrame) -> DataFrame:
    """Ranked rows that are no candidates of their strategy and date; any row means that a stage before is broken."""
    return ranked.join(candidates.select(*CROSS, "stock_id"), [*CROSS, "stock_id"], "left_anti")


def checked(ranked: DataFrame, candidates: DataFrame) -> DataFrame:
    """``ranked``, with a check that stops the job at a row that is no candidate of its strategy and date (see ``orphans``).

    The check is part of stock_id, so no plan that lists stocks can leave it out.
    """
    known = candidates.select(*CROSS, "stock_id").distinct().withColumn("__known", F.lit(True))
    message = F.concat(F.lit("a ranked row is no candidate: "), F.coalesce("stock_id", F.lit("?")))
    d = ranked.join(known, [*CROSS, "stock_id"], "left").withColumn("stock_id", F.when(F.col("__known").isNull(), F.raise_error(message)).otherwise(F.col("stock_id")))
    return d.select(*ranked.columns)


def report_rows(ranked: DataFrame) -> DataFrame:
    """ranked with the block of text of each row; a blank name is the id, lines without data are left out."""
    name = F.coalesce(F.nullif(strip(F.col("stock_name")), F.lit("")), F.col("stock_id"))
    change = change_percent(F.col("close"), F.col("reference"))
    block = F.concat_ws(
        "\n", F.format_string("%d. %s (%s)", "rank", name, "stock_id"),
        F.when(F.col("close").isNotNull(), F.format_string("close %.2f", F.col("close").cast("double"))), F.when(change.isNotNull(), F.format_string("change %+.2f%%", change)),
        F.format_string("score %.2f", "total_score"), F.format_string("data %.0f%%", F.col("completeness") * 100),
        F.when(F.size("missing_factors") > 0, F.concat(F.lit("missing: "), F.array_join(_shown(F.col("missing_factors"), REASONS), ", "))),
        F.when(F.size("top_factors") > 0, F.concat(F.lit("strong in: "), F.array_join(_shown(F.col("top_factors"), LABELS), ", "))),
        F.when(F.col("one_price"), F.lit("shape: one price all day")),
        F.concat(F.lit("risk: "), F.when(F.size("risk_flags") > 0, F.array_join(_shown(F.col("risk_flags"), FLAGS), ", ")).otherwise(NO_FLAG)),
    )
    return ranked.withColumn("block", block)


def render_report(spine: DataFrame, ranked: DataFrame) -> DataFrame:
    """spine (strategy_version, trading_date, published, n_candidates, n_eligible) with the report, its UTF-16 length and whether it is too long.

    n_candidates counts before the P/E rule. Each row of the spine gets a text, also when nothing is listed. No clock is read, so a rerun gives
    the same text. A report holds at most ``published`` blocks.
    """
    body = report_rows(ranked).groupBy(*CROSS).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col("block").alias("t")))), lambda x: x["t"]), "\n\n").alias("body"))
    d = spine.join(body, CROSS, "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    head = F.concat_ws(
        "\n", F.concat(F.lit("Limit-up list "), F.col("trading_date").cast("string")), F.concat(F.lit("strategy "), F.col("strategy_version")),
        F.concat(F.lit("candidates "), n("n_candidates"), F.lit(", complete enough "), n("n_eligible"), F.lit(", shown at most "), F.col("published").cast("int").cast("string")),
    )
    before, after = CLOSING.split("{}")
    closing = F.concat(F.lit(before), F.col("strategy_version"), F.lit(after))
    d = d.withColumn("report", F.concat_ws("\n\n", head, F.coalesce("body", F.lit(NOBODY)), closing))
    size = utf16_length(F.col("report"))
    return d.select(*spine.columns, "report", size.alias("n_units"), (size > LONGEST).alias("too_long"))
