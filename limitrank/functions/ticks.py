"""Tick sizes, price limits and the limit-up test, in exact decimals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parsing import strip

#: Upper end of each price band, exclusive, and its tick (fixed values).
BANDS = (("10", "0.01"), ("50", "0.05"), ("100", "0.10"), ("500", "0.50"), ("1000", "1"), ("999999999", "5"))
PRICE = "decimal(18,4)"


def _price(x: str) -> Column:
    return F.lit(x).cast(PRICE)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used; else plans grow with every use."""
    return F.transform(F.array(value), body)[0]


def tick_size(price: Column) -> Column:
    """Tick of a price's band; null outside [0, 999999999)."""
    def band(p: Column) -> Column:
        out = F.when(p < 0, F.lit(None).cast(PRICE))
        for top, tick in BANDS:
            out = out.when(p < _price(top), _price(tick))
        return out

    return _let(price.cast(PRICE), band)


def round_to_tick(price: Column, tick: Column, down: bool = True) -> Column:
    """Whole ticks toward zero, or to the nearest (halves away from zero)."""
    def rounded(x: Column) -> Column:
        steps = x["p"] / x["t"]
        whole = F.when(x["p"] < 0, F.ceil(steps)).otherwise(F.floor(steps)) if down else F.round(steps)
        return (whole.cast("decimal(18,0)") * x["t"]).cast(PRICE)

    return _let(F.struct(price.cast(PRICE).alias("p"), tick.cast(PRICE).alias("t")), rounded)


def limit_up_price(reference: Column) -> Column:
    """Highest legal price of a session: a tenth above the reference, down to the tick of that price's band; null unless positive."""
    def limit(r: Column) -> Column:
        raw = (r * F.lit("1.10").cast("decimal(3,2)")).cast(PRICE)
        return F.when(r > 0, _let(raw, lambda x: round_to_tick(x, tick_size(x))))

    return _let(reference.cast(PRICE), limit)


def resolve_limit_up(limited: Column, given: Column, reference: Column) -> Column:
    """Struct (price, source): none without a limit today, else the source's price, else the calculated one."""
    made = limit_up_price(reference)
    source = (
        F.when(~F.coalesce(limited, F.lit(False)), "UNAVAILABLE").when(given.isNotNull(), "SOURCE_PROVIDED")
        .when(made.isNotNull(), "CALCULATED").otherwise("UNAVAILABLE")
    )
    return F.struct(F.when(F.coalesce(limited, F.lit(False)), F.coalesce(given, made)).alias("price"), source.alias("source"))


def evaluate_limit_up(security: Column, quality: Column, close: Column, high: Column, limit: Column) -> Column:
    """Struct (closed, touched, reason); gates are tried in order and a failed one decides."""
    reason = (
        F.when(F.coalesce(security != "COMMON_STOCK", F.lit(True)), "not common stock").when(~F.coalesce(quality, F.lit(False)), "bad data")
        .when(close.isNull(), "no close").when(limit.isNull(), "no limit").when(close == limit, "closed at limit").otherwise("below limit")
    )
    open_ = reason.isin("closed at limit", "below limit")
    return F.struct(
        (reason == "closed at limit").alias("closed"), F.coalesce(open_ & (high == limit), F.lit(False)).alias("touched"), reason.alias("reason")
    )


def data_quality_ok(close: Column, high: Column, volume: Column, turnover: Column) -> Column:
    return F.coalesce(close.isNotNull() & high.isNotNull() & (volume > 0) & (turnover > 0), F.lit(False))


def is_one_price(o: Column, h: Column, low: Column, c: Column, limit: Column) -> Column:
    """Whether the stock traded at the limit only; false where anything is missing."""
    return F.coalesce((o == limit) & (h == limit) & (low == limit) & (c == limit), F.lit(False))


def is_ky(name: Column) -> Column:
    n = F.upper(strip(name))
    return F.coalesce(n.contains("-KY") | n.startswith("F-KY"), F.lit(False))


def change_percent(close: Column, reference: Column) -> Column:
    return F.when(reference > 0, (close.cast("double") / reference.cast("double") - 1) * 100)


def bounded_momentum_score(r: Column, low: float = 0.03, high: float = 0.15, hot: float = 0.40) -> Column:
    """Score of a return: rises to 100 between ``low`` and ``high`` and falls to 20 at ``hot``; null stays null."""
    return (
        F.when(r.isNull(), None).when(r <= 0, F.greatest(F.lit(0.0), 50 + 100 * r)).when(r < low, 50 + r / low * 25)
        .when(r <= high, 100.0).when(r >= hot, 20.0).otherwise(100 - 80 * (r - high) / (hot - high))
    )
