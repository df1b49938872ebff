"""Rankings, Pareto, shares, evolution and indicators over consolidated deliveries
(mes, producto_oficial, laboratorio, total_unidades, numero_de_entregas)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import month_name, month_order, share


def with_months(consolidated: DataFrame) -> DataFrame:
    return consolidated.withColumns({"mes_orden": month_order(F.col("mes")), "mes_nombre": month_name(F.col("mes"))})


def _totals(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("total_unidades").alias("total_unidades"), F.sum("numero_de_entregas").alias("frecuencia_entregas"))


def rank_products(consolidated: DataFrame, n: int = 50) -> DataFrame:
    """Products by units; of equal ones the first by name.  Only the n best rows are numbered."""
    best = _totals(consolidated, "producto_oficial").orderBy(F.desc("total_unidades"), "producto_oficial").limit(n)
    order = Window.orderBy(F.desc("total_unidades"), "producto_oficial")
    return best.select(F.row_number().over(order).alias("ranking"), "*")


def rank_products_monthly(consolidated: DataFrame, n: int = 50) -> DataFrame:
    """The n best products of every month."""
    totals = _totals(with_months(consolidated), "mes_orden", "mes_nombre", "producto_oficial")
    order = Window.partitionBy("mes_orden", "mes_nombre").orderBy(F.desc("total_unidades"), "producto_oficial")
    return totals.withColumn("ranking", F.row_number().over(order)).where(F.col("ranking") <= n)


def pareto(consolidated: DataFrame, n: int = 30) -> DataFrame:
    """The n best products with their running share of all units."""
    best = rank_products(consolidated, n).drop("frecuencia_entregas")
    whole = consolidated.agg(F.sum("total_unidades").alias("todo"))
    running = Window.orderBy("ranking").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = best.join(whole).withColumn("acumulado", F.sum("total_unidades").over(running))
    return out.withColumn("porcentaje_acumulado", share(F.col("acumulado"), F.col("todo"))).drop("todo")


def lab_share(consolidated: DataFrame, n: int = 10, others: str = "OTROS") -> DataFrame:
    """Units of the n largest laboratories and, if any are left, of the others."""
    labs = consolidated.groupBy("laboratorio").agg(F.sum("total_unidades").alias("total_unidades"))
    best = labs.orderBy(F.desc("total_unidades"), "laboratorio").limit(n)
    whole = labs.agg(F.sum("total_unidades").alias("todo"))
    rest = best.agg(F.sum("total_unidades").alias("mejores")).join(whole).select(F.lit(others).alias("laboratorio"), (F.col("todo") - F.col("mejores")).alias("total_unidades")).where("total_unidades > 0")
    both = best.union(rest).join(whole)
    return both.select("laboratorio", "total_unidades", share(F.col("total_unidades"), F.col("todo")).alias("participacion"))


def monthly_evolution(consolidated: DataFrame) -> DataFrame:
    return _totals(with_months(consolidated), "mes_orden", "mes_nombre").withColumnRenamed("frecuencia_entregas", "numero_de_entregas").orderBy("mes_orden", "mes_nombre")


def indicators(consolidated: DataFrame) -> DataFrame:
    """One row: totals, units per delivery, first and last month and the change between them (null with less than two)."""
    months = monthly_evolution(consolidated)
    # packed first and last month of at most a few dozen rows
    edge = months.agg(
        F.sum("total_unidades").alias("total_unidades"), F.sum("numero_de_entregas").alias("total_entregas"), F.count("*").alias("meses"),
        F.min(F.struct("mes_orden", "mes_nombre", "total_unidades")).alias("a"), F.max(F.struct("mes_orden", "mes_nombre", "total_unidades")).alias("b"),
    )
    enough = F.col("meses") >= 2
    change = F.when(F.col("a.total_unidades") > 0, (F.col("b.total_unidades") - F.col("a.total_unidades")) / F.col("a.total_unidades") * 100).otherwise(0.0)
    return edge.select(
        "total_unidades", "total_entregas", F.when(F.col("total_entregas") > 0, F.col("total_unidades") / F.col("total_entregas")).otherwise(0.0).alias("promedio"),
        F.when(enough, F.col("a.mes_nombre")).alias("mes_inicial"), F.when(enough, F.col("b.mes_nombre")).alias("mes_final"), F.when(enough, change).alias("variacion"),
    )


def indicator_text(row) -> str:
    """The indicators as a short report, whose wording is a fixed value."""
    if row["variacion"] is None:
        period, trend = "N/A", "N/A (Datos insuficientes para variación)"
    else:
        period = f"Comparativo: {row['mes_inicial']} vs {row['mes_final']}"
        trend = f"{'Crecimiento' if row['variacion'] >= 0 else 'Contracción del volumen'} ({row['variacion']:+.2f}%)"
    lines = [
        "INDICADORES DE GESTIÓN", "=" * 35, "", "1. EFICIENCIA OPERATIVA", f"   - Total Unidades Entregadas: {int(row['total_unidades'] or 0):,}",
        f"   - Total Entregas (Transacciones): {int(row['total_entregas'] or 0):,}", f"   - Promedio de Unidades por Entrega: {row['promedio']:.2f}", "",
        "2. EVOLUCIÓN DEL VOLUMEN", f"   - {period}", f"   - Variación Porcentual: {trend}",
    ]
    return "\n".join(lines) + "\n"
