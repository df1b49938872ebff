"""Hashes of shortened texts, and how few of the costs' reach the join."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from dispensa.functions import shortened
from dispensa.operators import prices


def left(text, times):
    return {"".join(text[i] for i in kept) for kept in combinations(range(len(text)), len(text) - times)} if times <= len(text) else set()


@pytest.fixture(scope="module")
def made(spark):
    """Rows of (number, kind, text, times) with their hashes."""
    rnd = random.Random(4)
    rows = [(i, rnd.randint(0, 2), "".join(rnd.choices("abé𝒳", k=rnd.randint(0, 9))), rnd.randint(-1, 3)) for i in range(400)]
    table = spark.createDataFrame(rows, "i int, kind int, text string, times int")
    return rows, table, F.array(shortened.piece(F.col("kind"), F.col("text"), F.col("times")))


def test_forms_by_brute_force(made):
    """Equal kinds and forms have equal hashes, others different ones; no row has one twice."""
    rows, table, pieces = made
    by_row, by_form = {}, {}
    for r in shortened.forms(table, pieces).collect():
        by_row.setdefault(r["i"], []).append(r["_k"])
    for i, kind, text, times in rows:
        forms = left(text, times) if times in (0, 1, 2) else set()
        assert len(by_row.get(i, [])) == len(set(by_row.get(i, []))) == len(forms)
        for form in forms:
            by_form.setdefault((kind, form), []).append(set(by_row[i]))
    shared = [set.intersection(*found) for found in by_form.values()]
    assert all(shared)
    assert len({k for found in by_row.values() for k in found}) == len(by_form)


@pytest.mark.parametrize("most", [shortened.FEWEST, shortened.MOST])
def test_filter_loses_none(spark, made, monkeypatch, most):
    """All that were seen pass, also where the filter is full; nothing passes one of an empty table."""
    monkeypatch.setattr(shortened, "MOST", most)
    _, table, pieces = made
    every = shortened.forms(table, pieces)
    some = every.where("i % 5 = 0")
    seen = {r["_k"] for r in some.collect()}
    wanted = {(r["i"], r["_k"]) for r in every.collect() if r["_k"] in seen}
    assert wanted <= {(r["i"], r["_k"]) for r in shortened.forms(table, pieces, shortened.Hashes(some)).collect()}
    assert shortened.forms(table, pieces, shortened.Hashes(some.where("false"))).count() == 0


def test_costs_unlike_all_targets_do_not_reach_the_join(spark, monkeypatch):
    """2,000 costs of about 150 forms each, of which all were sorted and joined."""
    rnd, passed, real = random.Random(6), [], prices.forms

    def counted(df, pieces, seen=None):
        out = real(df, pieces, seen)
        if seen:
            passed.append(out.count())
        return out

    monkeypatch.setattr(prices, "forms", counted)
    texts = ["".join(rnd.choices("abcdefghij", k=17)) for _ in range(2000)]
    words = spark.createDataFrame([(texts[0][:-1] + "z",)], "w string")
    found = prices.similar_candidates(words, "w", spark.createDataFrame([(t,) for t in texts], "o string"), "o", 0.88, 2).collect()
    assert [tuple(r) for r in found] == [(texts[0][:-1] + "z", texts[0])]
    assert 0 < sum(passed) < 2000 * 150 / 20
