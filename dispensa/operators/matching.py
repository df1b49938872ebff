"""The match cascade of deliveries against a primary and a secondary contract list.

Targets: ordinal, descripcion, codigo.  Events: descripcion, codigo, cantidad
(decimal), mes.  Only distinct descriptions are parsed and matched; the outcome
joins back to the events.  Target lists are ordinary join sides, so Spark
broadcasts them if they are small and shuffles otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import medication
from ..functions import vocabulary as voc
from ..functions.numbers import share
from ..scratch import materialize

MATCH = ["status", "target", "descripcion_target", "codigo_target", "observacion"]


def target_index(targets: DataFrame) -> DataFrame:
    """Targets with their parsed descriptions; the ordinal decides which is first.  Descriptions are parsed once, when this is called."""
    return targets.join(medication.parse_distinct(targets, "descripcion"), "descripcion")


def _first(index: DataFrame, keys: list[str]) -> DataFrame:
    best = F.min(F.struct("ordinal", "descripcion", "codigo", "form")).alias("t")
    return index.groupBy(*[F.col(k).alias(f"t_{k}") for k in keys]).agg(best)


def match_exact(parsed: DataFrame, index: DataFrame) -> DataFrame:
    """First target of equal components, dosages and form as `exact`; null without one."""
    keys = ["components", "dosages", "form"]
    first = _first(index, keys).withColumnRenamed("t", "exact")
    return parsed.join(first, [F.col(k) == F.col(f"t_{k}") for k in keys], "left").drop(*[f"t_{k}" for k in keys])


def match_presentation(parsed: DataFrame, index: DataFrame) -> DataFrame:
    """First target of equal components and dosages as `presentation`."""
    keys = ["components", "dosages"]
    first = _first(index, keys).withColumnRenamed("t", "presentation")
    return parsed.join(first, [F.col(k) == F.col(f"t_{k}") for k in keys], "left").drop(*[f"t_{k}" for k in keys])


def match_substitution(parsed: DataFrame, index: DataFrame) -> DataFrame:
    """First target of equal dosages that shares a component but not all, as `substitute` (with the common ones).

    Both sides are cut down to distinct (dosages, component) before they meet."""
    wanted = parsed.select("components", "dosages").distinct().withColumn("part", F.explode(F.array_distinct("components")))
    kinds = index.groupBy("components", "dosages").agg(F.min(F.struct("ordinal", "descripcion")).alias("t"))
    offered = kinds.select(F.col("components").alias("t_components"), F.col("dosages").alias("t_dosages"), "t", F.explode(F.array_distinct("components")).alias("t_part"))
    both = wanted.join(offered, (F.col("dosages") == F.col("t_dosages")) & (F.col("part") == F.col("t_part")))
    same = F.array_sort(F.array_distinct("components")) == F.array_sort(F.array_distinct("t_components"))
    best = both.where(~same).groupBy("components", "dosages").agg(F.min(F.struct(F.col("t.ordinal"), F.col("t.descripcion"), F.col("t_components").alias("components"))).alias("substitute"))
    common = F.array_sort(F.array_intersect(F.col("s_components"), F.col("substitute.components")))
    best = best.withColumnsRenamed({"components": "s_components", "dosages": "s_dosages"}).withColumn("common", common)
    return parsed.join(best, (F.col("components") == F.col("s_components")) & (F.col("dosages") == F.col("s_dosages")), "left").drop("s_components", "s_dosages")


def match_list(parsed: DataFrame, index: DataFrame) -> DataFrame:
    """Parsed descriptions with the outcome of one target list (MATCH columns)."""
    found = match_substitution(match_presentation(match_exact(parsed, index), index), index)
    empty = F.col("descripcion") == ""
    status = (
        F.when(empty, voc.NOT_FOUND).when(F.col("exact").isNotNull(), voc.EXACT).when(F.col("presentation").isNotNull(), voc.PRESENTATION)
        .when(F.col("substitute").isNotNull(), voc.SUBSTITUTION).otherwise(voc.NOT_FOUND)
    )
    found = found.withColumn("status", status)
    hit = F.when(F.col("status") == voc.EXACT, F.col("exact")).when(F.col("status") == voc.PRESENTATION, F.col("presentation"))
    observed = F.when(F.col("status") == voc.PRESENTATION, F.format_string("Se solicito %s pero contrato tiene %s", "form", "presentation.form")).when(
        F.col("status") == voc.SUBSTITUTION, F.concat(F.lit("Sugerido: "), "substitute.descripcion", F.lit(" (Base comun: ['"), F.array_join("common", "', '"), F.lit("'])"))
    )
    return found.withColumn("hit", hit).select(
        *parsed.columns, "status", F.col("hit.ordinal").alias("target"), F.col("hit.descripcion").alias("descripcion_target"),
        F.col("hit.codigo").alias("codigo_target"), F.coalesce(observed, F.lit("")).alias("observacion"),
    )


def match_cascade(events: DataFrame, primary: DataFrame, secondary: DataFrame | None = None) -> DataFrame:
    """Outcome per distinct description: only what the primary list doesn't find
    asks the secondary one; a suggestion of the primary list stays.

    A list is a table of targets or, to parse it once for many calls, its target_index."""
    parsed = medication.parse_distinct(events.withColumn("descripcion", F.coalesce("descripcion", F.lit(""))), "descripcion")
    first = materialize(match_list(parsed, _indexed(primary)).withColumn("fuente", F.lit("PRIMARY")), "matched")
    if secondary is None:
        return first
    open_ = first.where(F.col("status") == voc.NOT_FOUND).select(*parsed.columns)
    second = match_list(open_, _indexed(secondary)).where(F.col("status") != voc.NOT_FOUND)
    second = second.select(F.col("descripcion").alias("d"), *[F.col(c).alias(f"s_{c}") for c in MATCH])
    both = first.join(second, F.col("descripcion") == F.col("d"), "left")
    adopted = F.col("d").isNotNull()
    return both.select(
        *parsed.columns, *[F.when(adopted, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) for c in MATCH],
        F.when(adopted, F.lit("SECONDARY")).otherwise(F.lit("PRIMARY")).alias("fuente"),
    )


def _indexed(targets: DataFrame) -> DataFrame:
    return targets if "components" in targets.columns else target_index(targets)


def is_valid(status="status"):
    return F.col(status).isin(voc.EXACT, voc.PRESENTATION)


def classify(events: DataFrame, primary: DataFrame, secondary: DataFrame | None = None) -> DataFrame:
    """Every event with its outcome, score, method and whether it counts."""
    events = events.withColumn("descripcion", F.coalesce("descripcion", F.lit("")))
    outcome = match_cascade(events, primary, secondary).select("descripcion", "form", *MATCH, "fuente")
    table = lambda d: F.coalesce(*[F.when(F.col("status") == k, F.lit(v)) for k, v in d.items()])
    return events.join(outcome, "descripcion", "left").withColumn("score", table(voc.SCORES)).withColumn("metodo", table(voc.METHODS)).withColumn("valido", is_valid())


def audit_log(classified: DataFrame) -> DataFrame:
    """The audit log, one row per event."""
    suggested = F.col("status") == voc.SUBSTITUTION
    return classified.select(
        F.col("mes").alias("archivo"), F.col("descripcion").alias("descripcion_original"), F.col("codigo").alias("codigo_original"), F.col("status").alias("estado_match"),
        F.when(F.col("valido"), F.coalesce("descripcion_target", F.lit(""))).when(suggested, F.col("observacion")).otherwise("").alias("producto_contrato_sugerido"),
        F.when(F.col("valido"), F.coalesce("codigo_target", F.lit(""))).otherwise("").alias("codigo_contrato_sugerido"),
        F.format_string("%.1f", "score").alias("score"), "metodo", F.when(F.col("valido"), F.col("fuente")).otherwise("-").alias("fuente"),
        F.col("observacion").alias("observaciones_auditoria"), F.when(suggested, "SI").otherwise("").alias("posible_sustituto"),
    )


def unmatched(classified: DataFrame) -> DataFrame:
    """Events that don't count, suggestions included."""
    return classified.where(~F.col("valido")).select(
        F.col("mes").alias("archivo"), F.col("descripcion").alias("descripcion_original"), F.col("codigo").alias("codigo_original"),
        "cantidad", F.col("status").alias("estado"), F.col("observacion").alias("observacion"),
    )


def matched_quantities(classified: DataFrame) -> DataFrame:
    """Quantity by list, target and month."""
    return classified.where("valido and target is not null").groupBy("fuente", "target", "mes").agg(F.sum("cantidad").alias("cantidad"))


def coverage(classified: DataFrame, by: list[str]) -> DataFrame:
    """Total and matched quantity and the share of the latter; by=[] for all."""
    total = F.sum("cantidad").alias("total")
    matched = F.coalesce(F.sum(F.when(F.col("valido"), F.col("cantidad"))), F.lit(0)).cast("decimal(38,6)").alias("cruzado")
    out = classified.groupBy(*by).agg(total, matched) if by else classified.agg(total, matched)
    return out.withColumn("cobertura", share(F.col("cruzado").cast("double"), F.col("total").cast("double")))


def top_missing(classified: DataFrame, n: int = 50, order: str = "orden") -> DataFrame:
    """Descriptions with the largest unmatched quantity, and the first code seen with each: by `order`, or the smallest without such a column."""
    missing = classified.where(~F.col("valido"))
    code = F.min_by("codigo", order) if order in classified.columns else F.min("codigo")
    totals = missing.groupBy(F.col("descripcion").alias("descripcion_original")).agg(F.sum("cantidad").alias("cantidad"), code.alias("codigo_original"))
    return totals.orderBy(F.desc("cantidad"), "descripcion_original").limit(n)
