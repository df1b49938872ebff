"""Cascade, catalog, prices, files: small cases with known results."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dispensa.functions import vocabulary as voc
from dispensa.operators import catalog, consolidation, matching, prices, reports
from dispensa.sources import delivery_files, sinks
from dispensa.streaming import deliveries

CONTRACT = [(0, "ACETAMINOFEN 500MG TABLETA", "A"), (1, "ACETAMINOFEN 5MG + OXICODONA 325MG TABLETA", "B"), (2, "ACETAMINOFEN 500 MG TAB", "C")]
EVENTS = [("Acetaminofén 500 mg TAB REC", voc.EXACT, 0), ("ACETAMINOFEN 500MG CAPSULA", voc.PRESENTATION, 0), ("OXICODONA 325MG + ACETAMINOFEN 5MG TABLETA", voc.EXACT, 1),
          ("ACETAMINOFEN 5MG + HIDROCODONA 325MG TABLETA", voc.SUBSTITUTION, None), ("ACETAMINOFEN 600MG TABLETA", voc.NOT_FOUND, None), ("", voc.NOT_FOUND, None)]


def frames(spark):
    primary = spark.createDataFrame(CONTRACT, "ordinal long, descripcion string, codigo string")
    secondary = spark.createDataFrame([(0, "ACETAMINOFEN 600MG TABLETA", "S"), (1, "ACETAMINOFEN 5MG + HIDROCODONA 325MG TABLETA", "T")], primary.schema)
    rows = [(d, f"c{i}", Decimal(i + 1), "1enero") for i, (d, _, _) in enumerate(EVENTS)]
    return primary, secondary, spark.createDataFrame(rows, "descripcion string, codigo string, cantidad decimal(38,6), mes string")


def test_cascade(spark):
    primary, secondary, events = frames(spark)
    alone = {r["descripcion"]: (r["status"], r["target"]) for r in matching.match_cascade(events, primary).collect()}
    assert alone == {d: (s, t) for d, s, t in EVENTS}
    both = {r["descripcion"]: r for r in matching.match_cascade(events, primary, secondary).collect()}
    found = both["ACETAMINOFEN 600MG TABLETA"]
    assert (found["status"], found["fuente"]) == (voc.EXACT, "SECONDARY")
    assert both["ACETAMINOFEN 5MG + HIDROCODONA 325MG TABLETA"]["status"] == voc.SUBSTITUTION  # a suggestion stays
    assert both["ACETAMINOFEN 5MG + HIDROCODONA 325MG TABLETA"]["observacion"] == "Sugerido: ACETAMINOFEN 5MG + OXICODONA 325MG TABLETA (Base comun: ['ACETAMINOFEN'])"


def test_quantities_are_kept(spark):
    primary, secondary, events = frames(spark)
    classified = matching.classify(events, primary, secondary)
    assert classified.count() == len(EVENTS)
    counted = matching.matched_quantities(classified).agg(F.sum("cantidad")).first()[0]
    left = matching.unmatched(classified).agg(F.sum("cantidad")).first()[0]
    assert counted + left == 21
    assert matching.coverage(classified, []).first()["cruzado"] == counted
    assert matching.coverage(classified.limit(0), []).first()["cobertura"] == 0


def test_empty_targets_and_events(spark):
    primary, _, events = frames(spark)
    assert {r["status"] for r in matching.match_cascade(events, primary.limit(0)).collect()} == {voc.NOT_FOUND}
    assert matching.classify(events.limit(0), primary).count() == 0


def test_catalog(spark):
    keys = catalog.catalog_keys(spark.createDataFrame([(0, "abcdefgx"), (1, "abcdefgz"), (2, "abcdefga"), (3, "ABCDEFGX")], "ordinal long, n string"), "n")
    found = {r["llave_cruce"]: (r["producto_oficial"], r["match_found"]) for r in catalog.match_catalog(spark.createDataFrame([("ABCDEFGH",), ("ABCDEFGX",), ("ZZ",), ("",)], "llave_cruce string"), keys).collect()}
    assert found == {"ABCDEFGH": ("abcdefgz", 1.0), "ABCDEFGX": ("ABCDEFGX", 1.0), "ZZ": ("POR_REVISAR_CATALOGO: ZZ", 0.0), "": ("POR_REVISAR_CATALOGO: ", 0.0)}


def test_prices(spark):
    costs = spark.createDataFrame([(0, "Dolex  ", "10"), (1, "ADVIL $1,500", "20"), (2, "ASPIRINA FORTE X", "30"), (3, "Dolex  ", "11"), (4, None, "0")], "ordinal long, descripcion string, costo string")
    targets = spark.createDataFrame([(0, "Dolex"), (1, "advil"), (2, "ASPIRINA FORTES X"), (3, "NADA")], "ordinal long, descripcion string")
    found = {r["descripcion"]: (r["precio_encontrado"], r["metodo_coincidencia"]) for r in prices.look_up(targets, costs).collect()}
    assert found["Dolex"] == ("10", "exact_target->trim_cost")
    assert found["advil"] == ("20", "stripPrice_target->stripRobust_cost")
    assert found["ASPIRINA FORTES X"] == ("30", "fallback_sim_0.97")
    assert found["NADA"] == ("", "no_encontrado")
    assert prices.summary(prices.look_up(targets, costs)).first().asDict() == {"encontrados": 3, "no_encontrados": 1}


def test_reports(spark):
    rows = spark.createDataFrame([("1enero", "A", "L", 10.0, 2), ("2febrero", "B", "M", 10.0, 1), ("2febrero", "A", "L", 5.0, 1)], "mes string, producto_oficial string, laboratorio string, total_unidades double, numero_de_entregas long")
    assert [(r["ranking"], r["producto_oficial"]) for r in reports.rank_products(rows).orderBy("ranking").collect()] == [(1, "A"), (2, "B")]
    assert reports.indicators(rows).first()["variacion"] == 50.0
    assert reports.indicators(rows.where("mes = '1enero'")).first()["variacion"] is None
    assert "Crecimiento (+50.00%)" in reports.indicator_text(reports.indicators(rows).first())
    assert [r["laboratorio"] for r in reports.lab_share(rows, 1).orderBy("laboratorio").collect()] == ["L", "OTROS"]
    assert set(sinks.ranking_sheets(rows)) == {"Global_Periodo", "ENERO", "FEBRERO"}


def test_integrity(spark):
    a, b = spark.createDataFrame([(1.0,)], "x double"), spark.createDataFrame([(2.0,)], "y double")
    with pytest.raises(ValueError, match="changed"):
        consolidation.assert_integrity(consolidation.integrity(a, "x", b, "y"))


def test_files(spark, tmp_path):
    (tmp_path / "6junioEvento.csv").write_bytes("﻿Nombre;Cantidad;Extra\r\nSOLUCIÓN;1.000,5;a\nCORTA;2\nLARGA;3;b;c\n\"CON;SEP\";4;d\n".encode())
    (tmp_path / "7julioEvento.csv").write_bytes("descripcion,unidades\nSOLUCIÓN,7\n".encode("latin-1"))
    (tmp_path / "reporte_Evento.csv").write_text("a,b\n1,2\n")
    (tmp_path / "8Evento.csv").write_text("solo,otra\n1,2\n")
    paths = delivery_files.discover_events(spark, str(tmp_path))
    assert [delivery_files.month_of(p) for p in paths] == ["6junioEvento", "7julioEvento", "8Evento"]
    df, skipped = delivery_files.load_deliveries(spark, paths)
    found = {(r["mes_entrega"], r["descripcion_original"], r["cantidad"], r["Extra"]) for r in df.collect()}
    assert found == {("6junioEvento", "SOLUCIÓN", "1.000,5", "a"), ("6junioEvento", "CORTA", "2", ""), ("6junioEvento", "CON;SEP", "4", "d"), ("7julioEvento", "SOLUCIÓN", "7", None)}
    assert len(skipped) == 1
    targets = delivery_files.load_targets(spark, paths[1])
    assert [tuple(r) for r in targets.select("ordinal", "descripcion", "codigo").collect()] == [(0, "SOLUCIÓN", "")]
    sinks.write_deliverable(df.select("cantidad"), str(tmp_path / "out/x.csv"))
    assert (tmp_path / "out/x.csv").read_bytes().startswith(b"\xef\xbb\xbfcantidad\n")


def test_columns():
    assert delivery_files.detect_event_columns(["Producto", "Descripcion", "CUM", "Cant"]) == {"descripcion": "Descripcion", "codigo": "CUM", "cantidad": "Cant"}
    assert delivery_files.detect_pair(["producto", "nombre", "unidades"]) == {"descripcion_original": "nombre", "cantidad": "unidades"}
    assert delivery_files.detect_pair(["x"]) is None


def test_chunks(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("id"))
    found = {r["id"]: (r["indice"], r["parte"]) for r in delivery_files.chunk_numbers(df, ["id"], 30).collect()}
    assert found == {i: (i, i // 30 + 1) for i in range(100)}
    assert delivery_files.chunk_numbers(df.limit(0), ["id"]).count() == 0


def test_stream(spark, tmp_path):
    primary, secondary, _ = frames(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("descripcion;codigo;cantidad;mes\nACETAMINOFEN 500MG TABLETA;x;2,5;1enero\nOTRO;y;1;1enero\n")
    deliveries.match_stream(deliveries.read_events(spark, str(tmp_path / "in")), primary, secondary, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [(r["target"], float(r["cantidad"])) for r in deliveries.consolidated(spark, str(tmp_path / "out")).collect()] == [(0, 2.5)]
