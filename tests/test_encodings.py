"""Files whose first accented character comes after the sampled lines."""

import pytest

from dispensa.plans import jobs
from dispensa.sources import delivery_files

PLAIN = "".join(f"OTRO {i}MG TAB;x;1\n" for i in range(3 * delivery_files.SAMPLE_LINES))


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_late_accents(spark, tmp_path, encoding):
    path = tmp_path / "6junioEvento.csv"
    path.write_bytes(("nombre;codigo;cantidad\n" + PLAIN + "CODEÍNA 10MG SOLUCIÓN ORAL;y;5\n").encode(encoding))
    assert delivery_files.file_encoding(spark, str(path)) == encoding
    assert "CODEÍNA 10MG SOLUCIÓN ORAL" in [r["nombre"] for r in delivery_files.read_robust(spark, str(path)).collect()]
    assert "CODEÍNA 10MG SOLUCIÓN ORAL" in [r["nombre"] for r in delivery_files.read_sniffed(spark, str(path))[0].collect()]
    (tmp_path / "t.csv").write_text("descripcion;codigo_neg\nCODEINA 10MG SOLUCION ORAL;A\n")
    assert jobs.audit(spark, f"{tmp_path}/t.csv", None, [str(path)], f"{tmp_path}/out", "20260101") == {}
    found = spark.read.option("header", True).option("sep", ";").csv(f"{tmp_path}/out/reporte_matches_primary").collect()
    assert [tuple(r)[-1] for r in found] == ["5"]


def test_bytes_that_are_no_utf8(spark, tmp_path):
    for i, (raw, encoding) in enumerate([(b"a;b\n", "utf-8"), (b"", "utf-8"), (b"a\xc3\n\xa9;b\n", "latin-1"), (b"a;b\n\xff\n", "latin-1"), ("á;日本\n".encode(), "utf-8")]):
        (tmp_path / f"{i}.csv").write_bytes(raw)
        assert delivery_files.file_encoding(spark, str(tmp_path / f"{i}.csv")) == encoding
