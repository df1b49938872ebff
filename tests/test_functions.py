"""Golden rows of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from dispensa.functions import medication, numbers, phonetic, similarity, text
from dispensa.functions import vocabulary as voc


def apply(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


PARSED = [
    ("Codeína 30mg + Acetaminofén 325mg TAB", ["ACETAMINOFEN", "CODEINA"], [30, 325], "TABLETA"),
    ("ACETAMINOFEN 325MG + CODEINA 30MG TABLETA", ["ACETAMINOFEN", "CODEINA"], [30, 325], "TABLETA"),
    ("ACETAMINOFEN 500MG TAB REC", ["ACETAMINOFEN"], [500], "TABLETA"),
    ("ACETAMINOFEN 500MG CAPSULA", ["ACETAMINOFEN"], [500], "CAPSULA"),
    ("ACETAMINOFEN 500", ["ACETAMINOFEN"], [500], "DESCONOCIDA"),
    ("500 MG TABLETA", [], [500], "TABLETA"),
    ("OXIDO DE ZINC", ["OXIDO"], [], "DESCONOCIDA"),
    ("KETOCONAZOL 2G/100G (2%) CREMA TOPICA TUBO X 30G", ["KETOCONAZOL 2% TOPICA"], [2, 30, 100], "CREMA"),
    ("ADALIMUMAB 40MG/0.8ML (50MG/1ML) SOLUCION INYECTABLE JERINGA PRELLENADA", ["ADALIMUMAB SOLUCION JERINGA PRELLENADA"], [0.8, 1, 40, 50], "INYECTABLE"),
    ("MICOFENOLATO MOFETILO 500MG TABLETA | ALKEM | MYCOKEM", ["MICOFENOLATO MOFETILO ALKEM MYCOKEM"], [500], "TABLETA"),
    ("SUERO FISIOLOGICO 0.9% X 500 ML BOLSA", ["SUERO FISIOLOGICO 0.9%"], [500], "UNIDAD"),
    ("VITAMINA D3 14.000UI CAPSULA | PROCAPS | DEFEROL", ["VITAMINA D3 PROCAPS DEFEROL"], [14], "CAPSULA"),
    ("TIROTROPINA 1,1MG AMP", ["TIROTROPINA"], [1], "INYECTABLE"),
    ("ADAPALENO 0.1G/100G (0.1%)GEL TOPICO TUBO X 30G", ["ADAPALENO 0.1%"], [0.1, 30, 100], "GEL"),
    ("", [], [], "DESCONOCIDA"),
    (None, [], [], "DESCONOCIDA"),
]


def test_parse(spark):
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PARSED)], "i int, d string")
    found = medication.parse(df, "d").orderBy("i").collect()
    assert [(r["components"], r["dosages"], r["form"]) for r in found] == [(c, [float(x) for x in d], f) for _, c, d, f in PARSED]


def test_forms_are_ordered_by_length():
    assert len(voc.FORMS) == 70
    assert voc.FORM_ORDER[0] == "CAPSULA BLANDA" and voc.FORM_ORDER[-1] == "CP"
    assert [k for k in voc.FORM_ORDER if len(k) == 12] == ["TAB LIB PROL", "CAPSULA DURA"]


QUANTITIES = [("1.000", 1, 1000), ("1,000", 1, 1), ("1.000,50", 1000.5, 1000.5), ("1,000.50", 1000.5, 1.0005), ("1,000,000", 0, 0),
              ("1.000.000,5", 1000000.5, 1000000.5), ("30.0", 30, 300), ("$ 1 000", 1000, 0), ("-3", -3, -3), (None, 0, 0), ("NaN", 0, 0), ("1_0", 0, 0), ("1e3", 1000, 1000)]


def test_quantities(spark):
    values = [q[0] for q in QUANTITIES]
    assert [float(x) for x in apply(spark, numbers.parse_decimal, values)] == [q[1] for q in QUANTITIES]
    assert apply(spark, numbers.parse_colombian, values) == [q[2] for q in QUANTITIES]


def test_shown_quantity(spark):
    assert apply(spark, lambda c: numbers.shown_quantity(c.cast("decimal(38,6)")), ["300", "1.50", "-2", "0"]) == ["300", "1,5", "0", "0"]
    assert apply(spark, lambda c: numbers.decimal_comma(c.cast("decimal(38,6)")), ["300", "-2.25"]) == ["300", "-2,25"]


def test_months(spark):
    values = ["6junioEvento", "10octubreEvento", "13x", "abril"]
    assert apply(spark, numbers.month_order, values) == [6, 10, 13, 99]
    assert apply(spark, numbers.month_name, values) == ["JUNIO", "OCTUBRE", "MES_13", "abril"]


def test_trailing_price(spark):
    values = ["A $216,795", "A - $ 1.234,50", "ACETAMINOFEN 500", "X 1234", "A 12345.6", "$360", None]
    assert apply(spark, text.strip_trailing_price, values) == ["A", "A", "ACETAMINOFEN", "X 1", "A 12", "$360", ""]


def test_keys(spark):
    assert apply(spark, text.key_robust, ["  STRASSE​  ﬁn ", "straße fin"]) == ["strasse fin", "strasse fin"]
    assert apply(spark, text.key_trim, ["﻿ A  b "]) == ["A  b"]
    assert apply(spark, text.catalog_key, ["Ibuprofeno tab 500 MG  x"]) == ["IBUPROFENO TABLETA 500MG X"]
    assert apply(spark, text.normalize_description, ["Ácido  (50%) + ñ/ü"]) == ["ACIDO 50% + N U"]


def test_labs(spark):
    values = ["A | x lab | b", "A GENFAR", "A | tq | B", "A", None, "A || MK"]
    assert apply(spark, text.extract_lab, values) == ["X LAB", "GENFAR", "TQ", "NO_IDENTIFICADO", "NO_IDENTIFICADO", "MK"]
    assert apply(spark, text.extract_lab_canonical, values)[2] == "TECNOQUIMICAS"


def test_standard_key(spark):
    df = spark.createDataFrame([("Dolex 500 mg", 1.0), ("Dolex 500 mg", 0.0), ("Dolex", 1.0), (None, 1.0), ("Dolex 500 mg", None)], "d string, q double")
    found = [r[0] for r in df.select(text.standard_key(F.col("d"), F.col("q"))).collect()]
    assert found == ["DOLEX 500MG", *["POR_REVISAR"] * 4]


def test_clean_text(spark):
    assert apply(spark, text.clean_text, ["Acetaminofén 500MG TAB GENFAR | x", "GOTAS 0,5%"]) == ["ACETAMINOFEN 500 MG TABLETA", "SOLUCION 0.5 %"]


def test_phonetic(spark):
    assert apply(spark, phonetic.phonetic_code, ["TITAN", "URSODEOXICOLICO", "ADAPALENE", "BBPFVX", ""]) == ["T500", "U623", "A314", "B200", ""]


def test_features(spark):
    assert apply(spark, phonetic.numeric_features, ["500 MG 5 ML X", "2 % CREMA", "X"]) == [[5.0, 100.0, 500.0], [2.0, 20.0], []]


def test_first_word(spark):
    df = spark.createDataFrame([("ACIDO URSODEOXICOLICO", "ACIDO TIOCTICO"), ("ADAPALENO 1", "ADAPALENE 2"), ("500 MG", "X"), ("LOSARTAN", "LOSARTAM")], "a string, b string")
    assert [r[0] for r in df.select(phonetic.first_word_matches(F.col("a"), F.col("b"))).collect()] == [False, True, True, True]


def test_similarity(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide")], "a string, b string")
    assert [r[0] for r in df.select(similarity.block_ratio("a", "b")).collect()] == [0.25, 0.5]
    df = spark.createDataFrame([("kitten", "sitting"), ("", ""), ("abc", None)], "a string, b string")
    assert [r[0] for r in df.select(similarity.indel_ratio("a", "b")).collect()] == [pytest.approx(200 * 4 / 13), 100.0, None]
