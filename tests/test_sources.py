"""Files: quoted line breaks, folders of parts, order of rows, marks and names of what is written."""

from difflib import SequenceMatcher, get_close_matches

import pytest
from compare import DATA
from pyspark.sql import functions as F

from dispensa.functions import text
from dispensa.operators import catalog, consolidation, matching, prices
from dispensa.plans import jobs
from dispensa.plans.fixtures import Views
from dispensa.plans.queries import QUERIES
from dispensa.sources import delivery_files as files
from dispensa.sources import sinks


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "6junioEvento.csv").write_text('nombre;cantidad;nota\n"DOS\nLINEAS";1;a\nUNA;2;"b\n\nc"\n')
    (tmp_path / "7julioEvento.csv").write_text('nombre;cantidad;nota\n5" TUBO;3;x\n')
    rows, skipped = files.load_deliveries(spark, files.discover_events(spark, str(tmp_path)))
    assert not skipped
    assert {(r["descripcion_original"], r["cantidad"], r["nota"], r["mes_entrega"]) for r in rows.collect()} == {
        ("DOS\nLINEAS", "1", "a", "6junioEvento"), ("UNA", "2", "b\n\nc", "6junioEvento"), ('5" TUBO', "3", "x", "7julioEvento")}


def test_order_of_rows(spark, tmp_path):
    """Ordinals over splits and part files; the first code of a missing description."""
    folder = tmp_path / "8 mes+ñ%Evento.csv"
    folder.mkdir()
    n = 0
    for part in range(3):
        (folder / f"part-{part}.csv").write_text("descripcion,codigo_neg,cant\n" + "".join(f"FALTA 1MG,c{n + i},1\n" for i in range(500)))
        n += 500
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = files.load_targets(spark, str(folder)).collect()
        assert {(r["ordinal"], r["codigo"]) for r in found} == {(i, f"c{i}") for i in range(n)}
        events, _ = files.load_events(spark, files.discover_events(spark, str(tmp_path)))
        assert {r["mes"] for r in events.select("mes").distinct().collect()} == {"8 mes+ñ%Evento"}
        classified = matching.classify(events.withColumn("cantidad", F.col("cantidad").cast("decimal(38,6)")), spark.createDataFrame([(0, "X 1MG", "")], "ordinal long, descripcion string, codigo string"))
        assert [tuple(r) for r in matching.top_missing(classified).select("codigo_original", F.col("cantidad").cast("int")).collect()] == [("c0", 1500)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_chunks_with_ties(spark):
    """Numbers are 0 to n - 1 exactly, whatever further columns are read and however many rows tie."""
    rows = spark.range(600_000, numPartitions=7).select((F.col("id") % 9).alias("k"), F.col("id").alias("v"), F.md5(F.col("id").cast("string")).alias("t"))
    found = files.chunk_numbers(rows, ["k"])
    seen = found.groupBy("k").agg(F.countDistinct("indice").alias("n"), F.countDistinct("v").alias("v"), F.min("indice").alias("a"), F.max("indice").alias("b")).orderBy("k").collect()
    assert sum(r["n"] for r in seen) == 600_000 and all(r["n"] == r["v"] == r["b"] - r["a"] + 1 for r in seen)
    assert [r["a"] for r in seen] == sorted(r["a"] for r in seen) and seen[0]["a"] == 0
    few = files.chunk_numbers(rows, ["k"]).agg(F.countDistinct("indice"), F.max("indice"), F.max("parte")).first()
    assert tuple(few) == (600_000, 599_999, 40)


def test_written_names_and_marks(spark, tmp_path):
    rows = spark.createDataFrame([("6junio", " a ", 1), ("7/x=ñ", "b", 2)], "mes_entrega string, n string, q int")
    paths = sinks.write_months(rows, str(tmp_path / "out"))
    assert [p.rsplit("/", 1)[-1] for p in paths][:1] == ["6junio_LIMPIO.csv"]
    part = next((tmp_path / "out/6junio_LIMPIO.csv").glob("part-*.csv"))
    assert part.read_bytes() == "﻿mes_entrega,n,q\n6junio, a ,1\n".encode()


def test_summaries(spark, tmp_path):
    (tmp_path / "t.csv").write_text("descripcion\nACETAMINOFEN\nNADA PARECIDO\n")
    (tmp_path / "c.csv").write_text("descripcion,costo\nACETAMINOFEN,9\nOTRO,1\n")
    said = []
    jobs.look_up_prices(spark, f"{tmp_path}/t.csv", f"{tmp_path}/c.csv", f"{tmp_path}/precios", said.append)
    assert "1 | 1" in said[0] and "exact->exact" in said[1] and "'NADA PARECIDO'" in said[2] and len(said) == 3


def similar(target, cost):
    return SequenceMatcher(None, target, cost).ratio()


def robust(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(text.key_robust(F.col("t"))).collect()]


@pytest.fixture(scope="module")
def price_lists(spark):
    v = Views(spark, DATA)
    targets = [tuple(r) for r in v.price_targets.orderBy("ordinal").select("ordinal", "descripcion").collect()]
    costs = [tuple(r) for r in v.costs.orderBy("ordinal").select("ordinal", "descripcion", "costo").collect()]
    return targets, costs, robust(spark, [d for _, d in targets]), robust(spark, [d for _, d, _ in costs])


def test_prices_by_brute_force(spark, price_lists):
    targets, costs, t_keys, c_keys = price_lists
    ruled = {r["descripcion"] for r in QUERIES["price_rules_1_9"](spark, DATA).collect()}
    looked_up = {r["descripcion"]: r for r in QUERIES["price_lookup"](spark, DATA).collect()}
    fallback = {r["descripcion"]: (r["costo"], r["similitud"]) for r in QUERIES["price_fallback"](spark, DATA).collect()}
    missing = 0
    for (_, d), key in zip(targets, t_keys, strict=True):
        if d in ruled:
            assert looked_up[d]["similitud"] == 1.0
            continue
        sims = [similar(key, c) for c in c_keys]
        best = max(sims)
        if best >= prices.THRESHOLD:
            price = costs[sims.index(best)][2]
            assert fallback[d] == (price, round(best, 6))
            assert (looked_up[d]["precio_encontrado"], looked_up[d]["metodo_coincidencia"]) == (price, f"fallback_sim_{best:.2f}")
        else:
            missing += 1
            assert d not in fallback and looked_up[d]["metodo_coincidencia"] == prices.NOT_FOUND
    assert tuple(QUERIES["price_summary"](spark, DATA).first()) == (len(targets) - missing, missing)
    assert [r["descripcion"] for r in QUERIES["price_preview"](spark, DATA).orderBy("ordinal").collect()] == [d for _, d in targets[:10]]


def test_nearest_costs_by_brute_force(spark, price_lists):
    targets, costs, t_keys, c_keys = price_lists
    found = {(r["descripcion"], r["puesto"]): (r["costo_descripcion"], r["similitud"]) for r in QUERIES["price_top3"](spark, DATA).collect()}
    assert len(found) == 30
    for d in {d for d, _ in found}:
        key = t_keys[[x for _, x in targets].index(d)]
        ranked = sorted(range(len(costs)), key=lambda i: -similar(key, c_keys[i]))[:3]
        assert [found[d, k + 1] for k in range(3)] == [(costs[i][1], round(similar(key, c_keys[i]), 6)) for i in ranked]


def test_several_costs_of_one_key(spark):
    """The most similar wins, of equal ones the first; a key repeated by many rows is one candidate."""
    costs = spark.createDataFrame([(i, "DOLEX $1,500" if i % 2 else "DOLEX  $1,600", str(i)) for i in range(40)], "ordinal long, descripcion string, costo string")
    targets = spark.createDataFrame([("dolex $1,600",), ("DOLEX $1,500",), ("dolex $9,999",)], "descripcion string")
    found = {r["descripcion"]: r["costo"] for r in prices.match_rules(targets, costs).collect()}
    assert found["DOLEX $1,500"] == "1" and found["dolex $1,600"] == "0"
    sims = {c: similar("dolex", c) for c in ("dolex $1,500", "dolex $1,600")}
    assert found["dolex $9,999"] == ("0" if sims["dolex $1,600"] >= sims["dolex $1,500"] else "1")


def test_catalog_by_brute_force(spark):
    v = Views(spark, DATA)
    keys = {r["llave"]: r["oficial"] for r in catalog.catalog_keys(v.contract, "descripcion").collect()}
    raw = v.deliveries.select(F.col("descripcion").alias("descripcion_original"), "cantidad", F.col("mes").alias("mes_entrega"))
    rows = consolidation.sanitize_catalog(raw).collect()
    expected = {}
    for key in {r["llave_cruce"] for r in rows}:
        close = get_close_matches(key, list(keys), n=1, cutoff=catalog.CUTOFF) if key else []
        expected[key] = keys[close[0]] if close else f"POR_REVISAR_CATALOGO: {key}"
    totals: dict = {}
    hits: dict = {}
    for r in rows:
        name = expected[r["llave_cruce"]]
        units, n = totals.get((r["mes_entrega"], name, r["laboratorio"]), (0.0, 0))
        totals[r["mes_entrega"], name, r["laboratorio"]] = (units + r["cantidad_num"], n + 1)
        hits.setdefault(r["mes_entrega"], []).append(not name.startswith("POR_REVISAR"))
    found = {(r["mes"], r["producto_oficial"], r["laboratorio"]): (r["total_unidades"], r["numero_de_entregas"]) for r in QUERIES["consolidate_named"](spark, DATA).collect()}
    assert found == totals
    share = {r["archivo"]: r["coincidencia"] for r in QUERIES["file_audit_matched"](spark, DATA).collect()}
    assert share == {m: pytest.approx(100 * sum(x) / len(x), abs=1e-5) for m, x in hits.items()}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next(row, x, b)
    return row[-1]


def _next(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(row[j + 1], out[-1]))
    return out


def test_likeness_by_brute_force(spark):
    for r in QUERIES["token_match"](spark, DATA).orderBy("ordinal").limit(60).collect():
        a, b = r["descripcion"], r["otra"]
        assert r["parecido"] == pytest.approx(200 * lcs(a, b) / (len(a) + len(b)), abs=1e-5)
        x, y = a.split()[0], b.split()[0]
        if not r["coincide"]:
            assert x != y and 200 * lcs(x, y) / (len(x) + len(y)) <= 85
        elif x[0] != y[0]:
            assert 200 * lcs(x, y) / (len(x) + len(y)) > 85


def test_full_folding(spark):
    import unicodedata

    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    import hashlib

    for r in QUERIES["normalize_documents"](spark, DATA).collect():
        t = docs[r["doc_id"]]
        folded = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        assert r["plegado"] == hashlib.md5(folded.encode()).hexdigest()
        robust_ = "".join(c for c in t.replace("\xa0", " ").replace("﻿", "") if not (0x200B <= ord(c) <= 0x200F or 0x202A <= ord(c) <= 0x202E))
        assert r["robusta"] == hashlib.md5(" ".join(unicodedata.normalize("NFKC", robust_).split()).casefold().encode()).hexdigest()


def test_one_parser_per_plan(spark):
    """Parsed descriptions are read, not parsed again; the pivot aggregates once; nothing stays persisted."""
    found = QUERIES["pivot_by_month"](spark, DATA)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "CAPSULA BLANDA" not in plan
    assert plan.count("Aggregate [fuente") == 2  # quantities by month, and the pivot of them
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == 0
