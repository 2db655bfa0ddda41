"""Mixing sources to target weights by capped water-filling.

Sources in code-point order, NULL last, weigh 1, 2, 3, repeating. Together they are to take as many words as there are.
Every source gets its weight's share, but at most ``max_epochs`` times its own size: sources above that are
clamped, and what they leave is dealt to the others in proportion to their weights, until none is
above. All of it is whole-number arithmetic on one row per source, so reruns agree.

A source's target is taken as whole repetitions of all its documents and one seeded part of a
repetition: documents in the order of a seeded hash of their id, as many as fit, and from the one
at the cut its first words. Where the cut lies follows from distributed running totals; a source's
documents then compare their own hash with it, so the texts are not shuffled.

Defined cases: a NULL text has size 0. NULL is a source like any other; a source without words takes nothing. Rows with
the same id and source have the same place in the order; at the cut they share what is left evenly,
rounded down. All columns come out; ``<prefix>source_size``, ``<prefix>target`` and ``<prefix>taken`` are added
and replace columns of that name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfflow.functions.ordering import running_before
from shelfflow.sources.staging import stage

WIDE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Runs of anything but \\x20 and \\x09 to \\x0D; none in NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weighted(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """``source``, ``source_size`` and ``weight``, by place in the order of sources."""
    keyed = sizes.withColumns({"absent": F.col("source").isNull(), "one": F.lit(1).cast("long")})
    placed = running_before(keyed, [("absent", False), ("source", False)], ["one"])
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    weight = F.element_at(cycle, (F.col("one_before") % len(weights) + 1).cast("int"))
    return stage(placed.select("source", "source_size", weight.alias("weight")))


def water_level(sources: DataFrame, max_epochs: int) -> tuple[int, int]:
    """Words per unit of weight, as a fraction, at which the unclamped sources use up the rest."""
    cap = (F.col("source_size") * max_epochs).cast(WIDE)
    weight = F.col("weight").cast(WIDE)
    words, parts, settled = 0, 1, None
    while (words, parts) != settled:
        settled = (words, parts)
        above = cap * F.lit(parts).cast(WIDE) < weight * F.lit(words).cast(WIDE)
        total, clamped, rest = sources.agg(
            F.sum(F.col("source_size").cast(WIDE)), F.sum(F.when(above, cap)), F.sum(F.when(~above, weight))
        ).first()
        if total is None or rest is None:
            return words, parts
        words, parts = int(total) - int(clamped or 0), int(rest)
    return words, parts


def mix_sources(
    docs: DataFrame,
    size: str,
    id_column: str = "doc_id",
    source_column: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    max_epochs: int = 3,
    seed: int = 0,
    prefix: str = "",
) -> DataFrame:
    """The rows with the size and target of their source and the words the mix takes of them."""
    identity = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    draw = F.md5(F.concat(F.lit(f"{seed}|"), identity))
    rows = stage(
        docs.select(F.col(source_column).alias("source"), F.col(size).alias("size"), draw.alias("draw"), identity.alias("id"))
        .groupBy("source", "draw", "id")
        .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("copies"))
    )
    sources = _weighted(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    words, parts = water_level(sources, max_epochs)
    words, parts = F.lit(words).cast(WIDE), F.lit(parts).cast(WIDE)
    cap, share = F.col("source_size").cast(WIDE) * max_epochs, F.col("weight").cast(WIDE) * words
    target = F.when(cap * parts < share, cap.cast("double")).otherwise(share.cast("double") / parts.cast("double"))
    goal = F.when(cap * parts < share, cap).otherwise(F.floor((share * 2 + parts) / (parts * 2)))
    planned = sources.withColumns({"target": target, "goal": goal.cast("long")}).withColumn(
        "whole", F.expr("if(source_size = 0, 0, goal div source_size)")
    )
    planned = planned.withColumn("rest", F.col("goal") - F.col("whole") * F.col("source_size"))

    placed = running_before(rows, [("draw", False), ("id", False)], ["size"], ["source"])
    plan = planned.select(F.col("source").alias("s"), "source_size", "target", "whole", "rest")
    placed = placed.join(plan, placed["source"].eqNullSafe(plan["s"]))
    at_cut = (F.col("size_before") <= F.col("rest")) & (F.col("rest") < F.col("size_before") + F.col("size"))
    cuts = placed.filter(at_cut).select(
        F.col("source").alias("c"), "draw", "id", F.floor((F.col("rest") - F.col("size_before")) / F.col("copies")).alias("part")
    )
    plan = plan.join(cuts, plan["s"].eqNullSafe(cuts["c"]), "left").select(
        F.struct("s", "source_size", "target", "whole", "draw", "id", "part").alias("__plan")
    )
    out = [f"{prefix}source_size", f"{prefix}target", f"{prefix}taken"]
    kept = docs.drop(*out)
    mine, theirs = F.struct(draw.alias("draw"), identity.alias("id")), F.struct("__plan.draw", "__plan.id")
    extra = (
        F.when(F.col("__plan.draw").isNull(), 0)
        .when(mine < theirs, F.col(size))
        .when(mine == theirs, F.least(F.col("__plan.part"), F.col(size)))
        .otherwise(0)
    )
    taken = F.col("__plan.whole") * F.col(size) + extra
    joined = kept.join(plan, kept[source_column].eqNullSafe(plan["__plan.s"]))
    return joined.withColumns(
        {out[0]: F.col("__plan.source_size"), out[1]: F.col("__plan.target"), out[2]: taken.cast("long")}
    ).drop("__plan")
