"""Mixing sources to target weights by nested hash thresholds: no sort of documents, no Python on executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stored, stored

#: Bits that one round of histograms resolves, and rounds; together the 60 bits of a document's hash.
BITS, ROUNDS = 12, 5


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits from the id and the text; rows equal in both share it and are taken or left together."""
    key = F.concat_ws(":", F.lit("mix"), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _sums_before(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> tuple[DataFrame, str]:
    """``rows`` with the sum over all rows that come earlier in ``order`` for each item of ``sums``, and where they were written.

    Rows are dealt by ranges of ``order``, so no task holds more than one range; only one total per range (as many as there are
    partitions, whatever the input) is ordered in one task.
    """
    ranged, path = stored(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "mix")
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__range").agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    totals = totals.select("__range", *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"__{k}") for k in sums])
    summed = ranged.withColumns({k: F.coalesce(F.sum(c).over(inside), F.lit(0)) for k, c in sums.items()}).join(F.broadcast(totals), "__range")
    return summed.withColumns({k: F.col(k) + F.col(f"__{k}") for k in sums}).drop("__range", *[f"__{k}" for k in sums]), path


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_repeats: float) -> DataFrame:
    """Adds ``target`` to one row per source (source, source_size): weights repeat over sources in code-point order, null last.

    ``share`` of all sizes is dealt by weight; a target stops at ``max_repeats`` times its source's size and the excess
    goes to the others by weight until none is above. With sources in order of max size over weight the capped ones
    come first; the highest level that no later source is below is the one at which dealing ends. Works on the table of sources only,
    by ranges of it, so that sources may be as many as hosts; the driver gets three sums.
    """
    by_name = F.col("source").asc_nulls_last()
    deal = F.array(*[F.lit(float(w)) for w in weights])
    s, named = _sums_before(sizes, [by_name], {"place": F.lit(1)})
    s = s.withColumn("weight", F.element_at(deal, (F.col("place") % len(weights) + 1).cast("int"))).drop("place")
    s = s.withColumn("most", F.lit(float(max_repeats)) * F.col("source_size"))
    s, _ = _sums_before(s.withColumn("ratio", F.col("most") / F.col("weight")), [F.col("ratio"), by_name], {"most_before": F.col("most"), "weight_before": F.col("weight")})
    drop_stored(sizes.sparkSession, named)
    words, weight = s.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(float(share) * (words or 0)) - F.col("most_before")) / (F.lit(weight or 0.0) - F.col("weight_before"))
    dealt = s.select(level.alias("level"), "ratio").where("level <= ratio").agg(F.max("level")).first()[0]
    target = F.col("most") if dealt is None else F.least(F.col("most"), F.lit(dealt) * F.col("weight"))
    return s.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_repeats: float = 2.0,
) -> DataFrame:
    """doc_id, source, hash, size, source_size, target, repeats, taken for every row of ``docs`` (doc_id, source, text).

    A source takes whole passes over its documents and, for the rest of its target, the documents below a hash
    threshold. The threshold is found in rounds: sizes are summed by source and hash bucket, the bucket in which the
    budget ends is split further, all others are settled. The last cell is taken if that comes nearer to the target.
    A source's words are thus within half of one cell (one document, or rows equal in id and text) of its target.

    Null text: size 0, never taken. Null source: a source of its own, last. Null id: told apart by text. Sources whose
    size is 0 have target 0. Repeated rows share one decision. No rows: no rows. Extra columns are ignored. Hot
    sources are summed by bucket first, so a source costs at most 2**12 rows in any later task of a round.
    """
    d = docs.select("doc_id", "source", document_hash(F.col("doc_id"), F.col("text")).alias("hash"), word_count(F.col("text")).alias("size"))
    d, _ = stored(d, "mix")
    width = BITS * ROUNDS
    base = source_targets(d.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeats)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    base = base.withColumn("passes", passes)
    # `low` and `rest`: prefix of the boundary cell so far, and the budget that is left when it begins
    base, _ = stored(base.withColumns({"prefix": F.lit(0).cast("long"), "rest": F.col("target") - F.col("passes") * F.col("source_size")}), "mix")
    state = base.select("source", "prefix", "rest")
    for k in range(ROUNDS):
        shift = width - BITS * (k + 1)
        cell = F.shiftright("hash", shift)
        h = d.where(F.col("size") > 0).select("source", "size", cell.alias("cell"), F.shiftright("hash", shift + BITS).alias("prefix"))
        if k:
            h = h.alias("h").join(state.alias("s"), F.col("h.source").eqNullSafe(F.col("s.source")) & (F.col("h.prefix") == F.col("s.prefix"))).select("h.*")
        h = h.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
        h = h.alias("h").join(state.alias("s"), F.col("h.source").eqNullSafe(F.col("s.source"))).select("h.*", "s.rest")
        run = F.sum("cell_size").over(Window.partitionBy("source").orderBy("cell"))
        h = h.withColumn("upto", run)
        # the first cell that reaches the budget; where none does, the last one, which the budget then covers whole
        edge = F.min(F.when(F.col("upto") >= F.col("rest"), F.struct("cell", "upto", "cell_size"))).alias("edge")
        h = h.groupBy("source").agg(edge, F.max(F.struct("cell", "upto", "cell_size")).alias("last"), F.first("rest").alias("rest"))
        e = F.coalesce("edge", "last")
        state, _ = stored(h.select("source", e["cell"].alias("prefix"), (F.col("rest") - e["upto"] + e["cell_size"]).alias("rest"), e["cell_size"].alias("cell_size")), "mix")
    cut = state.select("source", (F.col("prefix") + F.when(F.col("rest") * 2 >= F.col("cell_size"), 1).otherwise(0)).alias("below"))
    plan = base.alias("b").join(cut.alias("c"), F.col("b.source").eqNullSafe(F.col("c.source")), "left").select("b.source", "b.source_size", "b.target", "b.passes", "c.below")
    out = d.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).select("d.*", "p.source_size", "p.target", "p.passes", "p.below")
    repeats = F.when(F.col("size") > 0, F.col("passes") + F.when(F.col("hash") < F.col("below"), 1).otherwise(0)).otherwise(0).cast("long")
    return out.withColumn("repeats", repeats).select("doc_id", "source", "hash", "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, with the columns of ``docs``.

    The decision is joined back on id and text hash. Edge cases as in ``mix``; a clashing column name is no trouble,
    as only doc_id, source and text are read and the others pass through.
    """
    chosen = mix(docs, **how).where(F.col("repeats") > 0).select("source", "doc_id", "hash", "repeats").distinct()
    d, c = docs.withColumn("__hash", document_hash(F.col("doc_id"), F.col("text"))).alias("d"), chosen.alias("c")
    same = F.col("d.__hash").eqNullSafe(F.col("c.hash")) & F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col("d.source").eqNullSafe(F.col("c.source"))
    rows = d.join(c, same).select("d.*", F.explode(F.sequence(F.lit(1), F.col("c.repeats"))).alias("__copy"))
    return rows.select(*[F.col(f"`{x}`") for x in docs.columns])
