"""Whole jobs over files: audit, sanitize, report, prices and split.

    python -m dispensa.plans.jobs audit --targets t.csv --targets_secondary s.csv --events FOLDER --out OUT
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import parse_decimal
from ..operators import catalog, consolidation, matching, prices, reports
from ..scratch import materialize, scratch_scope
from ..sources import delivery_files as files
from ..sources import sinks


def _table(title: str, df: DataFrame, columns: dict[str, str]) -> str:
    """A small table (one row per file, or a report's first rows) as text; formats by column."""
    rows = [" | ".join(columns)]
    rows += [" | ".join("" if r[c] is None else f.format(r[c]) for c, f in columns.items()) for r in df.select(*columns).collect()]
    return "\n".join(["=" * 60, title, "-" * 60, *rows, "=" * 60])


def audit(spark: SparkSession, targets: str, secondary: str | None, events: Sequence[str], out: str, day: str | None = None, say: Callable[[str], None] = print) -> dict[str, str]:
    """Matches event files to one or two contract lists and writes the audit's tables; returns why files were skipped."""
    rows, skipped = files.load_events(spark, events)
    if rows is None:
        return skipped
    with scratch_scope(spark):
        first = files.load_targets(spark, targets)
        second = files.load_targets(spark, secondary, "SECONDARY") if secondary else None
        day = day or date.today().strftime("%Y%m%d")
        classified = materialize(matching.classify(rows.withColumn("cantidad", parse_decimal(F.col("cantidad"))), first, second), "classified")
        months = sorted({files.month_of(p) for p in events if p not in skipped})
        quantities = materialize(matching.matched_quantities(classified), "quantities")
        all_targets = first.unionByName(second) if second is not None else first
        report = consolidation.match_report(quantities, all_targets, months)
        missing, by_file = materialize(matching.top_missing(classified), "missing"), matching.coverage(classified, ["mes"])
        sinks.write_csv(matching.audit_log(classified), f"{out}/auditoria_{day}", sinks.AUDIT_SEPARATOR)
        sinks.write_csv(matching.unmatched(classified), f"{out}/no_encontrados_{day}", sinks.AUDIT_SEPARATOR)
        sinks.write_csv(missing.orderBy(F.desc("cantidad"), "descripcion_original"), f"{out}/top_missing_targets_{day}", sinks.AUDIT_SEPARATOR)
        for source in ("PRIMARY", "SECONDARY"):
            sinks.write_csv(report.where(F.col("fuente_match") == source), f"{out}/reporte_matches_{source.lower()}", sinks.AUDIT_SEPARATOR)
        sinks.write_csv(consolidation.master_sheet(quantities, all_targets, months), f"{out}/reporte_sabana", sinks.AUDIT_SEPARATOR)
        sinks.write_csv(by_file, f"{out}/cobertura", sinks.AUDIT_SEPARATOR)
        amounts = {"total": "{:,.2f}", "cruzado": "{:,.2f}", "cobertura": "{:.2f}%"}
        say(_table("COBERTURA POR ARCHIVO", by_file.orderBy("mes"), {"mes": "{}", **amounts}))
        say(_table("TOP 50 PRODUCTOS FALTANTES", missing.orderBy(F.desc("cantidad"), "descripcion_original"), {"cantidad": "{:.0f}", "codigo_original": "{:.10}", "descripcion_original": "{:.60}"}))
        say(_table("RESUMEN FINAL", matching.coverage(classified, []), amounts))
        say(_table("FILAS POR FUENTE", quantities.groupBy("fuente").agg(F.countDistinct("target").alias("filas")).orderBy("fuente"), {"fuente": "{}", "filas": "{}"}))
    return skipped


def sanitize(spark: SparkSession, events: Sequence[str], out: str, catalog_path: str | None = None, say: Callable[[str], None] = print) -> dict[str, str]:
    """Cleans delivery files and consolidates them, by official name if a catalog is given."""
    rows, skipped = files.load_deliveries(spark, events)
    if rows is None:
        return skipped
    with scratch_scope(spark):
        if catalog_path:
            keys = catalog.catalog_keys(files.load_catalog(spark, catalog_path))
            clean = materialize(consolidation.with_catalog(consolidation.sanitize_catalog(rows), keys), "clean")
            total, quantity, matched = consolidation.consolidate_catalog(clean), "cantidad_num", "match_found"
        else:
            clean = materialize(consolidation.sanitize(rows), "clean")
            total, quantity, matched = consolidation.consolidate(clean), "cantidad", None
            consolidation.assert_integrity(consolidation.integrity(clean, "cantidad", total, "cantidad_total_entregada"))
        sinks.write_months(clean, f"{out}/limpio")
        by_file = consolidation.file_audit(clean, quantity, matched)
        sinks.write_csv(by_file, f"{out}/auditoria_archivos")
        total.write.mode("overwrite").parquet(f"{out}/consolidado.parquet")
        sinks.write_csv(total, f"{out}/consolidado.csv")
        shown = {"archivo": "{}", "total_registros": "{}", "suma_cantidades": "{:,.2f}"}
        say(_table("CONTROL DE INTEGRIDAD", by_file.orderBy("archivo"), shown | ({"coincidencia": "{:.2f}%"} if matched else {})))
        whole = by_file.agg(F.lit("TOTAL GENERAL").alias("archivo"), F.sum("total_registros").alias("total_registros"), F.sum("suma_cantidades").alias("suma_cantidades"))
        say(_table("TOTAL", whole, shown))
    return skipped


def report(spark: SparkSession, consolidated: str, out: str) -> None:
    """Rankings, Pareto, shares, evolution and indicators of a consolidated table."""
    rows = files.load_consolidated(spark, consolidated).persist()
    sinks.write_workbook(sinks.ranking_sheets(rows), f"{out}/ranking_top50.xlsx")
    sinks.write_chart(reports.pareto(rows), f"{out}/pareto.png", "producto_oficial", ["total_unidades", "porcentaje_acumulado"])
    sinks.write_chart(reports.lab_share(rows), f"{out}/laboratorios.png", "laboratorio", ["total_unidades"], "pie")
    sinks.write_chart(reports.monthly_evolution(rows), f"{out}/evolucion.png", "mes_nombre", ["total_unidades", "numero_de_entregas"], "line")
    sinks.write_indicators(reports.indicators(rows), f"{out}/indicadores.txt")
    rows.unpersist()


#: Rows of a result that are shown.
PREVIEW = 10


def look_up_prices(spark: SparkSession, targets: str, costs: str, out: str, say: Callable[[str], None] = print) -> DataFrame:
    """Price of every target, written with the targets' separator and shown in part; returns what was written."""
    wanted, sep = files.load_price_targets(spark, targets)
    offered = files.load_costs(spark, costs)
    with scratch_scope(spark):
        found = materialize(prices.look_up(wanted, offered), "prices")
        sinks.write_csv(found, out, sep)
        shown = {"descripcion": "{}", "precio_encontrado": "{}", "metodo_coincidencia": "{}", "similitud": "{:.3f}"}
        say(_table("RESUMEN", prices.summary(found), {"encontrados": "{}", "no_encontrados": "{}"}))
        say(_table("VISTA PREVIA", prices.preview(found, PREVIEW), shown))
        nearest = prices.nearest_costs(found, offered).orderBy("ordinal", "puesto")
        say(_table("NO ENCONTRADOS Y SUS CANDIDATOS", nearest, {"ordinal": "{}", "descripcion": "{!r}", "similitud": "{:.3f}", "costo_descripcion": "{!r}", "costo": "{}"}))
    return files.read_strings(spark, out, sep)


def split(spark: SparkSession, path: str, out: str, size: int = 15_000) -> None:
    """Parts of a file in its own order."""
    sinks.write_parts(files.number_file(spark, path, size), out)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, names in (("audit", ("targets", "targets_secondary", "events", "out")), ("sanitize", ("events", "catalog", "out")), ("report", ("consolidated", "out")), ("prices", ("targets", "costs", "out")), ("split", ("file", "out"))):
        job = jobs.add_parser(name)
        for option in names:
            job.add_argument(f"--{option}", required=option not in ("targets_secondary", "catalog"))
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.job == "audit":
        print(audit(spark, args.targets, args.targets_secondary, files.discover_events(spark, args.events), args.out))
    elif args.job == "sanitize":
        print(sanitize(spark, files.list_files(spark, f"{args.events}/*.csv"), args.out, args.catalog))
    elif args.job == "report":
        report(spark, args.consolidated, args.out)
    elif args.job == "prices":
        look_up_prices(spark, args.targets, args.costs, args.out)
    else:
        split(spark, args.file, args.out)


if __name__ == "__main__":
    main()
