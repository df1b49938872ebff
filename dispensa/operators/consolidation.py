"""Sanitized deliveries, their consolidations, audits and month pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.numbers import decimal_comma, parse_colombian, share, shown_quantity
from . import catalog as cat


def _described(rows: DataFrame, column: str, **derived: Column) -> DataFrame:
    """Rows with columns that follow from a text column alone, each computed once per distinct text and never null
    (which the optimizer sees, so that no later filter on them computes them again)."""
    texts = rows.select(F.col(column).alias("_text")).distinct().withColumns({name: F.coalesce(c, F.lit("")) for name, c in derived.items()})
    return rows.drop(*derived).join(texts, F.col(column).eqNullSafe(F.col("_text")), "left").drop("_text")


def sanitize(deliveries: DataFrame) -> DataFrame:
    """Deliveries (descripcion_original, cantidad as text, mes_entrega) with number, laboratory and standard key."""
    text = F.col("_text")
    out = _described(deliveries, "descripcion_original", laboratorio=tx.extract_lab(text), _key=tx.standard_text_key(text))
    out = out.withColumn("cantidad", parse_colombian(F.col("cantidad")))
    return out.withColumn("llave_de_cruce", tx.key_or_review(F.col("_key"), F.col("cantidad"))).drop("_key")


def sanitize_catalog(deliveries: DataFrame) -> DataFrame:
    """As sanitize, with the laboratory's standard name and the catalog spelling of the first pipe part."""
    text = F.col("_text")
    out = _described(deliveries, "descripcion_original", laboratorio=tx.extract_lab_canonical(text), llave_cruce=tx.catalog_key(tx.before_pipe(text)))
    return out.withColumn("cantidad_num", parse_colombian(F.col("cantidad")))


def consolidate(sanitized: DataFrame) -> DataFrame:
    """Quantity and deliveries by standard key and laboratory."""
    return sanitized.groupBy(F.col("llave_de_cruce").alias("medicamento_estandarizado"), "laboratorio").agg(
        F.sum("cantidad").alias("cantidad_total_entregada"), F.count("*").alias("numero_de_entregas_asociadas")
    )


def consolidate_catalog(named: DataFrame) -> DataFrame:
    """Units and deliveries by month, official product and laboratory; rows without one of these are left out."""
    known = named.where("mes_entrega is not null and producto_oficial is not null and laboratorio is not null")
    return known.groupBy(F.col("mes_entrega").alias("mes"), "producto_oficial", "laboratorio").agg(F.sum("cantidad_num").alias("total_unidades"), F.count("*").alias("numero_de_entregas"))


def with_catalog(sanitized: DataFrame, catalog_keys: DataFrame) -> DataFrame:
    return cat.map_back(sanitized, cat.match_catalog(sanitized, catalog_keys))


def file_audit(rows: DataFrame, quantity: str = "cantidad", matched: str | None = None) -> DataFrame:
    """Rows and quantity of each month's file, and the share of matched rows."""
    aggs = [F.count("*").alias("total_registros"), F.sum(quantity).alias("suma_cantidades")]
    if matched:
        aggs.append(share(F.sum(matched), F.count("*")).alias("coincidencia"))
    return rows.groupBy(F.col("mes_entrega").alias("archivo")).agg(*aggs)


def integrity(before: DataFrame, quantity: str, after: DataFrame, total: str, tolerance: float = 0.01) -> DataFrame:
    """Both sums and whether consolidation kept the quantity."""
    a, b = before.agg(F.sum(quantity).alias("entrada")), after.agg(F.sum(total).alias("salida"))
    return a.join(b).withColumn("integro", F.abs(F.coalesce("entrada", F.lit(0)) - F.coalesce("salida", F.lit(0))) < tolerance)


def assert_integrity(checked: DataFrame) -> None:
    row = checked.first()
    if not row["integro"]:
        raise ValueError(f"the quantity changed from {row['entrada']} to {row['salida']}")


def union_months(frames: list[DataFrame]) -> DataFrame:
    """All monthly frames, by name; what a month lacks is null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def month_pivot(quantities: DataFrame, keys: list[str], months: list[str], total: str = "total_acumulado") -> DataFrame:
    """One row per key, one column per month (lexicographic) and the row's total, which counts what the months hide: one aggregation."""
    months = sorted(months)
    zero = F.lit(0).cast("decimal(38,6)")
    sums = [F.coalesce(F.sum(F.when(F.col("mes") == m, F.col("cantidad"))), zero).alias(m) for m in months]
    wide = quantities.groupBy(*keys).agg(*sums, F.sum("cantidad").alias(total))
    return wide.select(*keys, *[shown_quantity(F.col(f"`{m}`")).alias(m) for m in months], decimal_comma(F.col(total)).alias(total))


def match_report(quantities: DataFrame, targets: DataFrame, months: list[str]) -> DataFrame:
    """The pivot of matched targets with their description and code.  targets: fuente, ordinal, descripcion, codigo."""
    pivot = month_pivot(quantities, ["fuente", "target"], months)
    named = targets.select("fuente", F.col("ordinal").alias("target"), F.col("descripcion").alias("descripcion_target"), F.col("codigo").alias("codigo_target"))
    return named.join(pivot, ["fuente", "target"]).select(F.col("fuente").alias("fuente_match"), "target", "descripcion_target", "codigo_target", *sorted(months), "total_acumulado")


def master_sheet(quantities: DataFrame, targets: DataFrame, months: list[str]) -> DataFrame:
    """Every target, with zeros where nothing matched."""
    pivot = month_pivot(quantities, ["fuente", "target"], months, "total_general")
    named = targets.select(F.col("fuente").alias("fuente_lista"), F.col("ordinal").alias("indice_original"), F.col("descripcion").alias("descripcion_master"), F.col("codigo").alias("codigo_master"))
    both = named.join(pivot, (F.col("fuente_lista") == F.col("fuente")) & (F.col("indice_original") == F.col("target")), "left")
    return both.select(*named.columns, *[F.coalesce(F.col(f"`{m}`"), F.lit("0")).alias(m) for m in sorted(months)], F.coalesce("total_general", F.lit("0")).alias("total_general"))


def sheet_check(primary: DataFrame, secondary: DataFrame, sheet: DataFrame) -> DataFrame:
    """Expected and actual rows of a master sheet."""
    expected = primary.select(F.lit(1)).union(secondary.select(F.lit(1))).agg(F.count("*").alias("esperados"))
    return expected.join(sheet.agg(F.count("*").alias("reales")))
