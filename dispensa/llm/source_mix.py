"""Mixing of sources to target weights with a cap on repetitions.

Method: capped water-filling.  Every source wants its weight's share of the
whole budget.  Sources that would exceed max_epochs times their size are clamped
there, and the excess is shared anew by weight among the others, until none is
above.  A source's rate (target / size) then gives every document its whole
repetitions; the fraction goes to the documents that come first in a seeded
order, up to the word count that is still missing, so a source misses its target
by at most half a document.

The seeded order is md5(seed:doc_id).  Only the bucket of the order where the
missing words run out is ranked document by document; whole buckets before it
are taken and those after it are not, so a source with a third of all rows is
never sorted in one task.  Only one row per source reaches the driver.

Null and empty texts have size 0 and keep the whole repetitions of their source.
Sources of size 0 have target 0.  Null is a source of its own, last in order.
Repeated rows are told apart by their text and, beyond that, share one place in
the order.  An empty table gives an empty result.  Extra columns are carried
along if named in `keep`; the operator's own columns win over clashing names."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Leading hexadecimal digits of the order that make a bucket.
BUCKET_DIGITS = 3
#: Up to so many sources (about 60 bytes each) their rates are broadcast; beyond that they are joined.
BROADCAST_SOURCES = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text) -> F.Column:
    """Words of a text; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: Sequence[int], weights: Sequence[int], max_epochs: int, budget: int | None = None) -> list[float]:
    """Targets by source.  What can't be placed under the caps stays unplaced."""
    left = sum(sizes) if budget is None else budget
    caps = [max_epochs * s for s in sizes]
    targets: list[float] = [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        weight = sum(weights[i] for i in free)
        above = {i for i in free if weights[i] * left > caps[i] * weight}
        if not above:
            for i in free:
                targets[i] = weights[i] * left / weight
            return targets
        for i in above:
            targets[i] = float(caps[i])
        left -= sum(caps[i] for i in above)
        free -= above
    return targets


def mix_sources(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix", keep: list[str] | None = None) -> DataFrame:
    """Repetitions of every document.

    docs: doc_id, source, text.  Sources, by code point with null last, get
    `weights` in turn.  Returns doc_id, the columns in `keep`, size, source_size,
    target, copies and taken (= copies * size)."""
    spark = docs.sparkSession
    own = {"doc_id", "size", "source_size", "target", "copies", "taken", "_src", "_at", "_bucket", "_text"}
    extra = [c for c in keep or [] if c not in own]
    at = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *extra, F.col("source").cast("string").alias("_src"), word_count("text").alias("size"), F.xxhash64("text").alias("_text"), at.alias("_at"))
    sized = sized.withColumn("_bucket", F.substring("_at", 1, BUCKET_DIGITS))
    if not extra:
        sized = materialize(sized, "mix-sizes")  # texts are read once
    words = materialize(sized.groupBy("_src", "_bucket").agg(F.sum("size").alias("words")), "mix-buckets")

    found = sorted(((r["_src"], int(r["words"])) for r in words.groupBy("_src").agg(F.sum("words").alias("words")).collect()), key=lambda r: (r[0] is None, (r[0] or "").encode()))
    targets = water_fill([size for _, size in found], [weights[i % len(weights)] for i in range(len(found))], max_epochs)
    plan = []
    for (source, size), target in zip(found, targets, strict=True):
        whole = math.floor(target / size) if size else 0
        plan.append((source, size, float(target), whole, float(target) - whole * size))
    rates = spark.createDataFrame(plan, "_src string, source_size long, target double, whole long, need double")

    ahead = F.coalesce(F.sum("words").over(Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    over = words.withColumn("before", ahead).alias("w").join(rates.alias("r"), F.col("w._src").eqNullSafe(F.col("r._src"))).where("need > 0 and before + words > need")
    cuts = over.groupBy(F.col("w._src").alias("c_src")).agg(F.min(F.struct("_bucket", "before")).alias("cut"))
    rates = rates.alias("r").join(cuts, F.col("r._src").eqNullSafe(F.col("c_src")), "left").select(F.col("r._src").alias("r_src"), "source_size", "target", "whole", "need", F.col("cut._bucket").alias("cut"), F.col("cut.before").alias("before"))
    if len(plan) <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    placed = sized.join(rates, F.col("_src").eqNullSafe(F.col("r_src")))
    edge = F.coalesce(F.col("_bucket") == F.col("cut"), F.lit(False))
    inside = Window.partitionBy("_src").orderBy("_at", "doc_id", "_text").rowsBetween(Window.unboundedPreceding, -1)
    missing = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / 2 <= F.col("need")
    ranked = placed.where(edge).withColumn("more", missing.cast("long"))
    others = placed.where(~edge).withColumn("more", F.coalesce(F.col("_bucket") < F.col("cut"), F.lit(False)).cast("long"))
    copies = (F.col("whole") + F.col("more")).cast("long")
    return others.unionByName(ranked).select("doc_id", *extra, "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
