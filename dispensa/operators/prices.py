"""Price lookup: nine key equalities in order, then similarity.

costs: ordinal, descripcion, costo.  targets: descripcion and any others."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.shortened import Hashes, Slices, forms
from ..functions.similarity import best_ratios, block_ratio, top_ratios
from ..scratch import materialize

THRESHOLD = 0.88
#: (label, key of the target, key of the cost) in order of precedence.
RULES = (
    ("exact->exact", "exact", "exact"),
    ("trim_target->exact_cost", "trim", "exact"),
    ("stripPrice_target->exact_cost", "strip_trim", "exact"),
    ("exact_target->trim_cost", "exact", "trim"),
    ("trim_target->trim_cost", "trim", "trim"),
    ("casefold_target->casefold_cost", "casefold", "casefold"),
    ("robust_target->robust_cost", "robust", "robust"),
    ("stripPrice_target->robust_cost", "strip_robust", "robust"),
    ("stripPrice_target->stripRobust_cost", "strip_robust", "strip_robust"),
)
NOT_FOUND = "no_encontrado"


def _with_keys(distinct: DataFrame) -> DataFrame:
    """Every key as `k_...`; what several keys begin with is a column of its own, or else each would compute it anew."""
    exact, cut = F.col("k_exact"), F.col("_cut")
    steps = (
        {"k_exact": tx.text_or_empty(F.col("descripcion"))},
        {"_cut": tx.strip_trailing_price(exact), "k_trim": tx.key_trim(exact), "_visible": tx.visible(exact)},
        {"k_strip_trim": tx.key_trim(cut), "_visible_cut": tx.visible(cut)},
        {"k_casefold": tx.key_casefold(F.col("k_trim")), "k_robust": tx.visible_robust(F.col("_visible")), "k_strip_robust": tx.visible_robust(F.col("_visible_cut"))},
    )
    for step in steps:
        distinct = distinct.withColumns(step)
    return distinct.drop("_cut", "_visible", "_visible_cut")


def _dealt(df: DataFrame, *by: str) -> DataFrame:
    """df in as many partitions as the session shuffles to, whatever its size: for few bytes with much work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _distinct(targets: DataFrame) -> DataFrame:
    return _dealt(targets.select(F.coalesce("descripcion", F.lit("")).alias("descripcion")).distinct())


def _first_costs(costs: DataFrame) -> DataFrame:
    """Distinct descriptions with ordinal and costo of their first cost: of equal texts no other can win."""
    found = costs.groupBy(F.coalesce("descripcion", F.lit("")).alias("descripcion")).agg(F.min(F.struct("ordinal", "costo")).alias("c"))
    return _dealt(found.select("descripcion", "c.ordinal", "c.costo"))


def _by_key(df: DataFrame, names: list[str], kinds: str, *others: Column) -> DataFrame:
    """A row for each different key of a row: key, and as bits which of the names it is the key of."""
    spread = df.select("*", F.explode(F.array_distinct(F.array(*[f"k_{name}" for name in names]))).alias("key"))
    bits = [F.when(F.col(f"k_{name}") == F.col("key"), F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(names)]
    return spread.select(*others, "key", sum(bits[1:], bits[0]).alias(kinds))


def match_rules(targets: DataFrame, costs: DataFrame) -> DataFrame:
    """descripcion (distinct), rule and cost of the first rule that hits; of several costs with the key the most similar, then the first."""
    return _ruled(targets, _with_keys(_first_costs(costs))).where("rule IS NOT NULL").select("descripcion", "rule", "costo").hint("merge")


def _ruled(targets: DataFrame, offers: DataFrame) -> DataFrame:
    """match_rules() with k_robust, and with a row without a rule for what none finds. offers: first costs with keys.

    One equi-join on the key: each side is a long table of its different keys, and what they are keys of gives the rules.
    Of the costs with one key and one robust text only the first can win, so they meet the targets as one row.

    Both sides and the result are of the lists' size, which the planner underestimates
    (a row has several keys), so they are sorted and merged, never broadcast."""
    asked, given = (list(dict.fromkeys(rule[side] for rule in RULES)) for side in (1, 2))
    long_t = _by_key(_with_keys(_distinct(targets)), asked, "t_kinds", F.col("descripcion"), F.col("k_robust"))
    long_c = _by_key(offers, given, "c_kinds", F.col("ordinal"), F.col("costo"), F.col("k_robust").alias("c_robust"))
    kinds = long_c.groupBy("key", "c_robust", "c_kinds").agg(F.min(F.struct("ordinal", "costo")).alias("c")).select("key", "c_robust", "c_kinds", "c.ordinal", "c.costo")
    has = lambda kinds, names, name: F.col(kinds).bitwiseAND(F.lit(1 << names.index(name))) != 0
    rule = F.coalesce(*[F.when(has("t_kinds", asked, a) & has("c_kinds", given, b), F.lit(i)) for i, (_, a, b) in enumerate(RULES)])
    hits = long_t.join(kinds.hint("merge"), "key", "left").select("descripcion", "k_robust", "c_robust", "ordinal", "costo", rule.alias("hit"))
    one = Window.partitionBy("descripcion")
    best = hits.withColumn("rule", F.min("hit").over(one)).where("rule IS NULL OR rule = hit").withColumn("n", F.count("*").over(one))
    open_ = (F.col("n") > 1) & F.col("rule").isNotNull() & (F.col("k_robust") != F.col("c_robust"))  # others need no ratio, or have 1
    best = best.withColumn("sim", block_ratio(F.when(open_, F.col("k_robust")), F.when(open_, F.col("c_robust"))))
    choice = F.max(F.struct("sim", (-F.col("ordinal")).alias("neg"), "costo")).alias("best")
    return best.groupBy("descripcion", "k_robust", "rule").agg(choice).select("descripcion", "k_robust", "rule", F.when(F.col("rule").isNotNull(), F.col("best.costo")).alias("costo"))


def length_reach(n: Column, cutoff: float) -> tuple[Column, Column]:
    """Lengths a partner of a text of length n may have: 2 min / sum >= cutoff."""
    return F.ceil(F.lit(cutoff) * n / (2 - cutoff)), F.floor(n * (2 - cutoff) / F.lit(cutoff))


def length_candidates(words: DataFrame, word: str, others: DataFrame, other: str, cutoff: float) -> DataFrame:
    """Pairs of distinct texts whose lengths allow the cutoff, as an equi-join on length."""
    low, high = length_reach(F.length(other), cutoff)
    spread = others.withColumn("_len", F.explode(F.sequence(low, F.greatest(low, high))))
    return words.withColumn("_len", F.length(word).cast("long")).join(spread, "_len").drop("_len")


#: Up to so many changes short texts meet by what is left of them without as many characters.
WHOLE, HALVED = 2, 5
#: Longest texts that do: their shortened forms grow with the square.
SHORT = 32
_SLACK = 1e-9  # sums of floats may fall just short of a whole number


def _reach(n: Column, cutoff: float) -> Column:
    """The lengths, 1 at least, of partners of a text of length n."""
    low, high = F.ceil(F.lit(cutoff) * n / (2 - cutoff) - _SLACK), F.floor(n * (2 - cutoff) / F.lit(cutoff) + _SLACK)
    return F.sequence(F.greatest(low, F.lit(1)).cast("int"), F.greatest(high, low, F.lit(1)).cast("int"))


def _changes(m: Column, n: Column, cutoff: float, most: int | None) -> Column:
    """Insertions and deletions that texts of these lengths may need at the cutoff, or `most`."""
    found = F.floor((1 - cutoff) * (m + n) + _SLACK).cast("int")
    return found if most is None else F.least(found, F.lit(most))


def _most_changes(m: int, n: int, cutoff: float, most: int | None) -> int:
    """_changes() of numbers."""
    found = math.floor((1 - cutoff) * (m + n) + _SLACK)
    return found if most is None else min(found, most)


def _cuts(others: DataFrame, other: str) -> dict[int, int]:
    """By length: where a text is cut in two, such that both parts tell many texts apart; any place is right, this only saves work."""
    n = F.col("_n")
    places = others.select(other, F.length(other).alias("_n")).where(n.between(4, SHORT)).withColumn("_h", F.explode(F.sequence((n / 4).cast("int"), (n * 3 / 4).cast("int"))))
    parts = places.groupBy("_n", "_h").agg(F.approx_count_distinct(F.substring(other, F.lit(1), F.col("_h"))).alias("a"), F.approx_count_distinct(F.substring(other, F.col("_h") + 1, n)).alias("b"))
    best = parts.groupBy("_n").agg(F.max_by("_h", F.struct(F.least("a", "b"), -F.abs(F.col("_h") * 2 - n))).alias("_h")).collect()  # at most one row for each short length
    return {r["_n"]: r["_h"] for r in best}


def similar_candidates(words: DataFrame, word: str, others: DataFrame, other: str, cutoff: float, most: int | None = None) -> DataFrame:
    """Every pair of distinct texts whose ratio may reach the cutoff (of no more than `most` changes), each once.

    Matching blocks are a common subsequence, so a ratio of c or more means at
    most d = (1 - c) (m + n) characters inserted or deleted between texts of m and
    n characters.  Short texts of few changes meet in their shortened forms, others
    in segments, all by equi-joins: exactly, without all pairs.  Texts of no
    character match only each other."""
    short = _shortened_pairs(words, word, others, other, cutoff, most)
    met = short if most is not None and most <= WHOLE else short.unionByName(_segment_pairs(words, word, others, other, cutoff, most))
    empty = words.select(word).distinct().join(others.where(F.col(other) == "").hint("merge"), F.col(word) == F.col(other))
    return met.distinct().unionByName(empty)


def _is_short(m: Column, n: Column, d: Column) -> Column:
    return (d <= HALVED) & (F.greatest(m, n) <= SHORT)


def _shortened_pairs(words: DataFrame, word: str, others: DataFrame, other: str, cutoff: float, most: int | None) -> DataFrame:
    """Pairs of short texts by a common subsequence.

    Texts of m and n characters and at most t changes share one of
    ceil((m + n - t) / 2) characters: both leave out what they have more.  Where one
    would leave out more than two, the other text is cut in two.  Its first part needs at most d // 2
    changes from a beginning of the word, or its second at most d - 1 - d // 2 from
    the end; beginning and end are longer or shorter by no more than these.

    The words' forms are written; of the others' only those are handed on that a filter of bounded size takes for one of them."""
    first, second = lambda d: d // 2, lambda d: d - 1 - d // 2
    left_out = lambda a, b, t: (a - b + t) // 2  # noqa: E731  # of a characters: a - ceil((a + b - t) / 2)
    whole = lambda m, n, d: max(left_out(m, n, d), left_out(n, m, d)) <= WHOLE
    kind = lambda n, number: n * 3 + number
    cuts = _cuts(others, other) if most is None or most > WHOLE else {}

    asked: dict[int, list[tuple[int, int, int, int]]] = {}  # by the word's length: pieces of the word
    offered: dict[int, list[tuple[int, int, int, int]]] = {}  # by the other text's length: pieces of it
    for n in range(1, SHORT + 1):
        h = cuts.get(n, n // 2)
        for m in range(1, SHORT + 1):
            d = _most_changes(m, n, cutoff, most)
            if d > HALVED or abs(m - n) > d:
                continue
            mine, others_ = asked.setdefault(m, []), offered.setdefault(n, [])
            if whole(m, n, d):
                mine.append((kind(n, 0), 0, m, left_out(m, n, d)))
                others_.append((kind(n, 0), 0, n, left_out(n, m, d)))
                continue
            for number, size, t in ((1, h, first(d)), (2, n - h, second(d))):
                mine += [(kind(n, number), 0 if number == 1 else m - q, q, left_out(q, size, t)) for q in range(max(0, size - t), min(m, size + t) + 1)]
                others_ += [(kind(n, number), 0 if number == 1 else h, size, times) for times in range(t + 1)]

    n = F.length(word)
    parts = materialize(forms(_dealt(words.select(word), word).distinct().where(n.between(1, SHORT)), Slices(word, asked)), "shortened")
    cut = forms(others.where(F.length(other).between(1, SHORT)), Slices(other, offered), Hashes(parts)).select("_k", *others.columns)
    met = cut.join(parts.hint("merge"), "_k").withColumn("_d", _changes(n, F.length(other), cutoff, most))
    return met.where(F.expr(f"levenshtein(`{word}`, `{other}`, _d) >= 0")).select(word, *others.columns)


def _segment_pairs(words: DataFrame, word: str, others: DataFrame, other: str, cutoff: float, most: int | None) -> DataFrame:
    """Pairs of other texts by shared segments.

    The other text is cut into more segments than any partner may
    have changes, hence one of them stands in the word unchanged, moved by no more
    than the changes before and behind it allow.  The segments meet in an
    equi-join on (length, segment number, segment)."""
    n, m = F.col("_n"), F.col("_m")
    longest = F.floor(n * (2 - cutoff) / F.lit(cutoff) + _SLACK)
    count = F.least(_changes(longest, n, cutoff, most) + 1, n)  # of segments; single characters where more changes are allowed
    begin = lambda i: F.floor(i * n / count).cast("int")
    needed = F.exists(_reach(n, cutoff), lambda m: ~_is_short(m, n, _changes(m, n, cutoff, most)))
    cut = others.withColumn("_n", F.length(other)).where("_n > 0").where(needed).select("*", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias("_i"))
    cut = cut.withColumns({"_p": begin(F.col("_i")), "_e": begin(F.col("_i") + 1)}).withColumn("_s", F.substring(other, F.col("_p") + 1, F.col("_e") - F.col("_p"))).drop("_p", "_e")

    parts = words.select(word).distinct().withColumn("_m", F.length(word)).where("_m > 0").withColumn("_n", F.explode(_reach(m, cutoff)))
    parts = parts.withColumn("_d", _changes(m, n, cutoff, most)).where(~_is_short(m, n, F.col("_d"))).withColumn("_i", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
    parts = parts.withColumns({"_p": begin(F.col("_i")), "_e": begin(F.col("_i") + 1)})
    # moved by s: |s| + |(m - n) - s| <= d
    move = F.sequence(F.ceil((m - n - F.col("_d")) / 2).cast("int"), F.floor((m - n + F.col("_d")) / 2).cast("int"))
    parts = parts.withColumn("_at", F.explode(F.transform(move, lambda s: F.col("_p") + s))).where("_at >= 0 and _at + _e - _p <= _m")
    parts = parts.withColumn("_s", F.substring(word, F.col("_at") + 1, F.col("_e") - F.col("_p"))).select(word, "_n", "_i", "_s", "_d").distinct()
    # few bytes with much work: dealt to all tasks, whatever their size
    parts = parts.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_n", "_i", "_s")
    # an insertion or deletion is an edit, so the number of edits is a lower bound of theirs
    met = parts.hint("merge").join(cut, ["_n", "_i", "_s"]).where(F.expr(f"levenshtein(`{word}`, `{other}`, _d) >= 0"))
    return met.select(word, *others.columns)


def match_similar(targets: DataFrame, costs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """descripcion, cost and similarity of the most similar cost (the first of equals) at or above the threshold."""
    robust = lambda df: df.withColumn("k_robust", tx.key_robust(F.col("descripcion")))
    return _similar(materialize(robust(_distinct(targets)), "wanted"), robust(_first_costs(costs)), threshold)


def _similar(wanted: DataFrame, offers: DataFrame, threshold: float) -> DataFrame:
    """match_similar() of distinct descriptions and first costs with k_robust; wanted is asked for several times.

    Short texts are first compared with those of two changes at most: with three or
    more, the ratio of a text of m characters is 2 m / (2 m + 3) or less, so what
    is more similar is settled.  Only the rest meets all it may be similar to."""
    offered = offers.groupBy(F.col("k_robust").alias("c_robust")).agg(F.min(F.struct("ordinal", "costo")).alias("c")).select("c_robust", "c.ordinal", "c.costo")
    offered = materialize(_dealt(offered), "offered")

    def best(words: DataFrame, most: int | None) -> DataFrame:
        scored = best_ratios(similar_candidates(words, "k_robust", offered, "c_robust", threshold, most), "k_robust", "c_robust", threshold)
        return scored.groupBy("k_robust").agg(F.max(F.struct("sim", (-F.col("ordinal")).alias("neg"), "costo")).alias("b"))

    m = F.length("k_robust")
    near = materialize(best(wanted.where(m <= SHORT - WHOLE), WHOLE).where(F.col("b.sim") > 2 * m / (2 * m + WHOLE + 1) + _SLACK), "near")
    rest = materialize(_dealt(wanted.select("k_robust").distinct().join(near.hint("merge"), "k_robust", "left_anti")), "far")
    found = near.unionByName(best(rest, None)).hint("merge")
    return wanted.join(found, "k_robust").select("descripcion", F.col("b.costo").alias("costo"), F.col("b.sim").alias("similitud"))


def look_up(targets: DataFrame, costs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """targets with precio_encontrado, metodo_coincidencia and similitud; similarity only sees what no rule finds."""
    targets = targets.withColumn("descripcion", F.coalesce("descripcion", F.lit("")))
    offers = materialize(_with_keys(_first_costs(costs)), "offers")
    ruled = materialize(_ruled(targets, offers), "ruled")
    label = F.coalesce(*[F.when(F.col("rule") == i, F.lit(name)) for i, (name, _, _) in enumerate(RULES)])
    by_rule = ruled.where("rule IS NOT NULL").select("descripcion", F.col("costo").alias("precio_encontrado"), label.alias("metodo_coincidencia"), F.lit(1.0).alias("similitud"))
    similar = _similar(ruled.where("rule IS NULL").select("descripcion", "k_robust"), offers, threshold).select(
        "descripcion", F.col("costo").alias("precio_encontrado"), F.format_string("fallback_sim_%.2f", "similitud").alias("metodo_coincidencia"), "similitud"
    )
    found = targets.join(by_rule.unionByName(similar).hint("merge"), "descripcion", "left")
    return found.withColumns({
        "precio_encontrado": F.coalesce("precio_encontrado", F.lit("")), "metodo_coincidencia": F.coalesce("metodo_coincidencia", F.lit(NOT_FOUND)),
        "similitud": F.coalesce("similitud", F.lit(0.0)),
    })


def summary(looked_up: DataFrame) -> DataFrame:
    """Found and not found."""
    missing = F.col("metodo_coincidencia") == NOT_FOUND
    return looked_up.agg(F.count_if(~missing).alias("encontrados"), F.count_if(missing).alias("no_encontrados"))


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    """The first rows."""
    return rows.orderBy("ordinal").limit(n)


def look_up_first(targets: DataFrame, costs: DataFrame, n: int = 10) -> DataFrame:
    """preview(look_up()), looking up only the targets it shows, among all costs: a target's price depends on no other target."""
    return preview(look_up(materialize(preview(targets, n), "first"), costs), n)


def not_found(looked_up: DataFrame) -> DataFrame:
    return looked_up.where(F.col("metodo_coincidencia") == NOT_FOUND)


def nearest_costs(looked_up: DataFrame, costs: DataFrame, first: int = 10, each: int = 3) -> DataFrame:
    """A diagnosis of the first unmatched targets (ordinal): the most similar costs of each, of equal ones the first.

    The report's few targets are a literal beside every cost; each batch hands on only rows that may be among the most similar."""
    some = not_found(looked_up).orderBy("ordinal").limit(first).select("ordinal", "descripcion").withColumn("t_robust", tx.key_robust(F.col("descripcion")))
    offered = costs.select(F.col("ordinal").alias("costo_ordinal"), F.col("descripcion").alias("costo_descripcion"), "costo", tx.key_robust(F.col("descripcion")).alias("c_robust"))
    asked = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("ordinal", "descripcion", "t_robust")]) for r in some.collect()])  # at most `first` rows
    scored = offered.withColumn("t", F.explode(asked.cast("array<struct<ordinal:bigint,descripcion:string,t_robust:string>>"))).select("*", "t.*")
    scored = top_ratios(scored.drop("t"), "ordinal", "t_robust", "c_robust", each).withColumnRenamed("sim", "similitud")
    order = Window.partitionBy("ordinal").orderBy(F.desc("similitud"), "costo_ordinal")
    return scored.withColumn("puesto", F.row_number().over(order)).where(F.col("puesto") <= each).select("ordinal", "descripcion", "puesto", "costo_descripcion", "costo", "similitud")
