"""Whole jobs over small files."""

from dispensa.plans import jobs


def test_jobs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/6junioEvento.csv").write_text("nombre;codigo;cantidad\nACETAMINOFEN 500 MG TAB;x;2\nOTRO 5MG TAB;y;1\n", encoding="utf-8")
    (tmp_path / "t.csv").write_text("descripcion;codigo_neg\nACETAMINOFEN 500MG TABLETA;A\n")
    (tmp_path / "c.csv").write_text("descripcion,costo\nACETAMINOFEN 500MG TABLETA,9\n")
    (tmp_path / "cat.csv").write_text("producto_genhospi,otra\nACETAMINOFEN 500MG TABLETA,1\n")
    out = str(tmp_path / "out")
    events = [f"{tmp_path}/in/6junioEvento.csv"]
    assert jobs.audit(spark, f"{tmp_path}/t.csv", None, events, out, "20260101") == {}
    rows = [tuple(r) for r in spark.read.option("header", True).option("sep", ";").csv(f"{out}/reporte_matches_primary").collect()]
    assert rows == [("PRIMARY", "0", "ACETAMINOFEN 500MG TABLETA", "A", "2", "2")]
    assert jobs.sanitize(spark, events, out, f"{tmp_path}/cat.csv") == {}
    assert sorted(r["producto_oficial"] for r in spark.read.parquet(f"{out}/consolidado.parquet").collect()) == ["ACETAMINOFEN 500MG TABLETA", "POR_REVISAR_CATALOGO: OTRO 5MG TABLETA"]
    jobs.report(spark, f"{out}/consolidado.parquet", out)
    assert "INDICADORES" in (tmp_path / "out/indicadores.txt").read_text()
    found = jobs.look_up_prices(spark, f"{tmp_path}/t.csv", f"{tmp_path}/c.csv", f"{out}/precios").collect()
    assert [(r["precio_encontrado"], r["metodo_coincidencia"]) for r in found] == [("9", "exact->exact")]
    jobs.split(spark, f"{tmp_path}/c.csv", f"{out}/partes")
    assert spark.read.option("header", True).csv(f"{out}/partes").columns == ["indice", "descripcion", "costo", "parte"]
