"""Price queries over lists too large to broadcast."""

import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from dispensa.functions import similarity
from dispensa.operators import prices
from dispensa.plans.fixtures import Views
from dispensa.plans.queries import QUERIES


@pytest.fixture(scope="module")
def many_parts(spark, tmp_path_factory):
    """part.parquet, small as a file, of which each row has nine keys."""
    folder = tmp_path_factory.mktemp("parts")
    spark.range(20_000).selectExpr("id AS p_partkey", "'red bolt' AS p_name", "'Brand#1' AS p_brand", "1 AS p_size", "900.0D AS p_retailprice").write.parquet(f"{folder}/part.parquet")
    return str(folder)


def joins(df):
    """Physical joins as first planned: their kind and build side."""
    return re.findall(r"(BroadcastHashJoin|BroadcastNestedLoopJoin|CartesianProduct|SortMergeJoin)", df._jdf.queryExecution().sparkPlan().toString())


def test_price_counts_broadcasts_no_list(spark, many_parts):
    found = QUERIES["price_counts"](spark, many_parts)
    assert set(joins(found)) == {"SortMergeJoin"}
    assert found.first().asDict() == {"encontrados": 17_142, "no_encontrados": 2_858}


def test_price_rules_broadcast_no_list(spark, many_parts):
    found = QUERIES["price_rules_1_9"](spark, many_parts)
    assert set(joins(found)) == {"SortMergeJoin"}
    assert found.count() == 17_142


def test_lookup_of_top3_broadcasts_no_list(spark, many_parts):
    views = Views(spark, many_parts)
    assert set(joins(prices.look_up(views.price_targets, views.costs, threshold=0.999))) == {"SortMergeJoin"}
    assert QUERIES["price_top3"](spark, many_parts).count() == 30


def test_top_ratios(spark):
    """The three first rows of each group, as if all ratios were computed; ties, empty and missing texts included."""
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("abc ", k=rnd.randint(0, 9))) for _ in range(300)] + [None]
    rows = [(g, w, t, i) for g, w in ((0, "abcab"), (1, ""), (2, "ca b")) for i, t in enumerate(texts)]
    pairs = spark.createDataFrame(rows, "g int, w string, o string, i int").repartition(3)
    found = similarity.top_ratios(pairs, "g", "w", "o", 3).collect()
    for g, w in ((0, "abcab"), (1, ""), (2, "ca b")):
        every = sorted((-SequenceMatcher(None, w, t or "").ratio(), i) for i, t in enumerate(texts))
        assert sorted((-r["sim"], r["i"]) for r in found if r["g"] == g)[:3] == every[:3]


@pytest.fixture(scope="module")
def alike_parts(spark, tmp_path_factory):
    """Parts of one name, so that all prices share most of their text."""
    folder = tmp_path_factory.mktemp("alike")
    spark.range(100_000, 102_000).selectExpr("id AS p_partkey", "'red bolt' AS p_name", "'Brand#1' AS p_brand", "1 AS p_size", "900.0D AS p_retailprice").write.parquet(f"{folder}/part.parquet")
    return str(folder)


@pytest.fixture
def met(monkeypatch):
    """Numbers of pairs that met, whether their edits allow the threshold or not."""
    counts, real, expr = [], prices.best_ratios, F.expr

    def counted(pairs, *args, **kwargs):
        counts.append(pairs.count())
        return real(pairs, *args, **kwargs)

    monkeypatch.setattr(prices, "best_ratios", counted)
    monkeypatch.setattr(F, "expr", lambda text: F.lit(True) if text.startswith("levenshtein") else expr(text))
    return counts


@pytest.mark.parametrize("name", ["price_fallback", "price_lookup", "price_preview", "price_summary"])
def test_texts_alike_do_not_all_meet(spark, alike_parts, met, name):
    """Of 286 targets and 2,000 costs with a frequent beginning, which were all pairs."""
    assert len(QUERIES[name](spark, alike_parts).collect()) > 0
    assert 0 < sum(met) < 286 * 2000 / 4


@pytest.mark.parametrize("cutoff", [0.5, 0.85, 0.88, 0.95, 0.999])
@pytest.mark.parametrize("most", [None, 2])
def test_candidates_by_brute_force(spark, cutoff, most):
    """No pair is lost, none comes twice; short, long, empty texts and characters of several bytes."""
    rnd, letters = random.Random(5), "abcé𝒳"

    def changed(t):
        for _ in range(rnd.randint(0, 5)):
            i = rnd.randint(0, len(t))
            t = t[:i] + rnd.choice(["", *letters]) + t[i + rnd.randint(0, 1) :]
        return t

    base = ["".join(rnd.choices(letters, k=rnd.randint(0, 40))) for _ in range(40)]
    words, others = ({changed(rnd.choice(base)) for _ in range(n)} | {""} for n in (100, 200))
    found = prices.similar_candidates(spark.createDataFrame([(x,) for x in words], "w string"), "w", spark.createDataFrame([(x,) for x in others], "o string"), "o", cutoff, most).collect()
    pairs = {tuple(r) for r in found}
    assert len(pairs) == len(found)
    for x in words:
        for y in others:
            common, n = similarity._common(x, y), len(x) + len(y)
            near = most is None or (n - 2 * common <= most and max(len(x), len(y)) <= prices.SHORT)
            if x == y == "" or x and y and 2 * common / n >= cutoff and near:
                assert (x, y) in pairs


def test_summary_deals_its_work(spark, alike_parts, monkeypatch):
    """Costs' keys and shortened forms are made by all tasks, though the lists are few bytes, and their pieces by no expression of each row."""
    files, plans, write, forms = {}, [], prices.materialize, prices.forms

    def written(df, name):
        out = write(df, name)
        files.setdefault(name, []).append(len(out.inputFiles()))
        return out

    def made(*args):
        out = forms(*args)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(prices, "materialize", written)
    monkeypatch.setattr(prices, "forms", made)
    assert QUERIES["price_summary"](spark, alike_parts).first().asDict() == {"encontrados": 2000, "no_encontrados": 0}
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert files["shortened"] == [tasks, tasks] and files["offers"] == files["offered"] == [tasks]
    assert plans and not any("lambda" in plan for plan in plans)


def test_rules_with_many_kinds_of_keys(spark):
    """Against the nine rules one after the other: texts that are several keys of each other, prices, white space, case, nothing."""
    rnd = random.Random(8)
    texts = ["", " ", None, "100", "$1,500", *("".join(rnd.choice(["a", "A", " ", "  ", "\u00a0", "\u200b", "É", "ß", "b", " $1,500", " 100"]) for _ in range(rnd.randint(1, 5))) for _ in range(300))]
    targets = spark.createDataFrame([(i, t) for i, t in enumerate(texts[::2])], "ordinal long, descripcion string")
    costs = spark.createDataFrame([(i, t, str(i)) for i, t in enumerate(texts[1::2])], "ordinal long, descripcion string, costo string")
    keyed = lambda df: [r.asDict() for r in prices._with_keys(df).collect()]
    for r in (rows := keyed(targets)):  # each key as by its own expression
        assert r["k_exact"] == (r["descripcion"] or "")
    offered, expected = keyed(costs), {}
    for t in rows:
        for i, (_, a, b) in enumerate(prices.RULES):
            if hits := [c for c in offered if c[f"k_{b}"] == t[f"k_{a}"]]:
                best = max(hits, key=lambda c: (SequenceMatcher(None, t["k_robust"], c["k_robust"]).ratio(), -c["ordinal"]))
                expected[t["k_exact"]] = (i, best["costo"])
                break
    assert {r["descripcion"]: (r["rule"], r["costo"]) for r in prices.match_rules(targets, costs).collect()} == expected
    assert len({rule for rule, _ in expected.values()}) > 4


def test_staged_keys(spark):
    """Keys computed in steps are those of the whole expressions."""
    tx = prices.tx
    rows = spark.createDataFrame([(t,) for t in ("", None, " Ab\u00a0c ", "\ufeffÉ\u200b x  $1,500 ", "ß 100", "100 ", "x \u200b- 1.000,50", "A\tB $5 $6")], "descripcion string")
    x = tx.text_or_empty(F.col("descripcion"))
    cut = tx.strip_trailing_price(x)
    whole = {"exact": x, "trim": tx.key_trim(x), "strip_trim": tx.key_trim(cut), "casefold": tx.key_casefold(x), "robust": tx.key_robust(x), "strip_robust": tx.key_robust(cut)}
    for r in prices._with_keys(rows).select("*", *[c.alias(name) for name, c in whole.items()]).collect():
        for name in whole:
            assert r[f"k_{name}"] == r[name], (r, name)


def test_preview_looks_up_what_it_shows(spark, alike_parts, monkeypatch):
    """The first ten rows of the whole lookup, with their prices among all costs; the other 1,990 targets are not looked up."""
    sought, real = [], prices.similar_candidates

    def counted(words, word, others, *args):
        sought.append((words.count(), others.count()))
        return real(words, word, others, *args)

    whole = QUERIES["price_lookup"](spark, alike_parts).orderBy("ordinal").limit(10).collect()
    monkeypatch.setattr(prices, "similar_candidates", counted)
    found = QUERIES["price_preview"](spark, alike_parts)
    assert found.columns == list(whole[0].asDict()) and sorted(found.collect()) == sorted(whole)
    assert all(0 < words <= 10 and others == 2000 for words, others in sought if words) and any(words for words, _ in sought)
