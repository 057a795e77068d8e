"""Strategy versions: thresholds, penalties and weights, read from a JSON list and put beside rows as one struct column."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, fields
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The versions that come with the library (fixed values of the published strategy).
DEFAULT = Path(__file__).with_name("strategies.json")


@dataclass(frozen=True)
class Strategy:
    version: str
    candidates: int
    least_turnover: float
    published: int
    most_pe: float
    most_streak: int
    hot_return: float
    least_completeness: float
    allow_attention: bool
    allow_ky: bool
    allow_one_price: bool
    penalties: dict[str, float]
    weights: dict[str, float]

    def __post_init__(self):
        if self.published <= 0 or self.candidates <= 0:
            raise ValueError("candidates and published must be positive")
        if self.most_pe <= 0:
            raise ValueError("the largest P/E must be positive")


def load_strategies(path: str | Path = DEFAULT) -> list[Strategy]:
    """All versions of a file. Unknown or absent keys and repeated versions are errors."""
    found = [Strategy(**row) for row in json.loads(Path(path).read_text())]
    if len({s.version for s in found}) != len(found):
        raise ValueError("a strategy version occurs twice")
    return found


def strategy_column(s: Strategy) -> Column:
    """A struct of literals; numbers are doubles, penalties and weights maps."""
    def literal(x):
        if isinstance(x, dict):
            return F.create_map(*[y for k, v in x.items() for y in (F.lit(k), F.lit(float(v)))])
        return F.lit(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else F.lit(x)

    values = asdict(s)
    return F.struct(*[literal(values[f.name]).alias(f.name) for f in fields(s)])


def for_each_strategy(rows: DataFrame, strategies: Sequence[Strategy]) -> DataFrame:
    """Every row once for each version, with strategy_version and the struct ``strategy``; the list is unfolded in place, without a join."""
    d = rows.select("*", F.explode(F.array(*[strategy_column(s) for s in strategies])).alias("strategy"))
    return d.withColumn("strategy_version", F.col("strategy.version"))
