"""The registered queries over the derived tables, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import medication, phonetic, similarity
from ..functions import numbers as num
from ..functions import text as tx
from ..functions import vocabulary as voc
from ..operators import catalog, consolidation, matching, prices, reports
from ..scratch import scratch_path
from ..sources import delivery_files as files
from ..sources import sinks
from ..sources.delivery_files import chunk_numbers
from .fixtures import MONTHS, Views, ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _normal(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(strip_accents(upper({c})), '[^A-Z0-9+.%\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _parsed(name: str, source: str, c: str = "descripcion") -> str:
    """CTEs that end in `name`: distinct descriptions of a relation, parsed."""
    phrase = " ".join(rf"WHEN regexp_matches(clean, '\b{k}\b') THEN '{k}'" for k in voc.FORM_ORDER)
    form = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in voc.FORMS.items())
    dose = r"\b(\d+(?:[.,]\d+)?)\s*(MG|MCG|G|UI|IU|GR|ML|%)\b"
    return rf"""
{name}_n AS (SELECT DISTINCT {c} AS d, {_normal(c)} AS clean FROM {source}),
{name}_f AS (SELECT *, CASE {phrase} END AS phrase FROM {name}_n),
{name}_r AS (SELECT *, CASE WHEN phrase IS NULL THEN clean ELSE regexp_replace(clean, '\b' || phrase || '\b', ' ', 'g') END AS rest FROM {name}_f),
{name} AS (SELECT d, clean, CASE phrase {form} ELSE '{voc.UNKNOWN_FORM}' END AS form,
  list_sort(list_distinct(list_transform(CASE WHEN len(regexp_extract_all(rest, '{dose}', 1)) > 0 THEN regexp_extract_all(rest, '{dose}', 1)
    ELSE regexp_extract_all(rest, '\b(\d+(?:[.,]\d+)?)\b', 1) END, lambda x: CAST(x AS DOUBLE)))) AS dosages,
  list_sort(list_filter(list_transform(string_split(regexp_replace(rest, '{dose}', ' ', 'g'), '+'), lambda s: array_to_string(list_filter(regexp_split_to_array(s, '\s+'),
    lambda w: NOT list_contains([{_quoted(voc.IGNORED_WORDS)}], w) AND NOT regexp_full_match(w, '\d+') AND length(w) > 1), ' ')), lambda x: x <> '')) AS components
  FROM {name}_r)"""


def _list(prefix: str, source: str, events: str) -> str:
    """CTEs that end in `prefix`_m: outcome of one target list for the parsed descriptions of `events`."""
    p = prefix
    return rf"""
{p}_t AS (SELECT c.*, t.form, t.components, t.dosages FROM v_contract c JOIN pt t ON t.d = c.descripcion WHERE fuente = '{source}'),
{p}_e AS (SELECT components, dosages, form, arg_min(ordinal, ordinal) AS o, arg_min(descripcion, ordinal) AS od, arg_min(codigo, ordinal) AS oc FROM {p}_t GROUP BY ALL),
{p}_p AS (SELECT components, dosages, arg_min(ordinal, ordinal) AS o, arg_min(descripcion, ordinal) AS od, arg_min(codigo, ordinal) AS oc, arg_min(form, ordinal) AS of FROM {p}_t GROUP BY ALL),
{p}_k AS (SELECT DISTINCT components, dosages FROM {events}),
{p}_j AS (SELECT k.components, k.dosages, t.ordinal, t.descripcion, t.components AS tc FROM {p}_k k JOIN {p}_t t ON k.dosages = t.dosages AND list_has_any(k.components, t.components)
          AND list_sort(list_distinct(k.components)) <> list_sort(list_distinct(t.components))),
{p}_s AS (SELECT components, dosages, arg_min(descripcion, ordinal) AS sd, list_sort(list_intersect(components, arg_min(tc, ordinal))) AS common FROM {p}_j GROUP BY components, dosages),
{p}_m AS (SELECT e.*, CASE WHEN e.d = '' THEN '{voc.NOT_FOUND}' WHEN x.o IS NOT NULL THEN '{voc.EXACT}' WHEN y.o IS NOT NULL THEN '{voc.PRESENTATION}'
            WHEN z.sd IS NOT NULL THEN '{voc.SUBSTITUTION}' ELSE '{voc.NOT_FOUND}' END AS status,
          CASE WHEN e.d <> '' THEN coalesce(x.o, y.o) END AS target, CASE WHEN e.d <> '' THEN CASE WHEN x.o IS NOT NULL THEN x.od ELSE y.od END END AS descripcion_target,
          CASE WHEN e.d <> '' THEN CASE WHEN x.o IS NOT NULL THEN x.oc ELSE y.oc END END AS codigo_target,
          CASE WHEN e.d = '' OR x.o IS NOT NULL THEN '' WHEN y.o IS NOT NULL THEN 'Se solicito ' || e.form || ' pero contrato tiene ' || y.of
            WHEN z.sd IS NOT NULL THEN 'Sugerido: ' || z.sd || ' (Base comun: [''' || array_to_string(z.common, ''', ''') || '''])' ELSE '' END AS observacion
          FROM {events} e LEFT JOIN {p}_e x ON e.components = x.components AND e.dosages = x.dosages AND e.form = x.form
          LEFT JOIN {p}_p y ON e.components = y.components AND e.dosages = y.dosages LEFT JOIN {p}_s z ON e.components = z.components AND e.dosages = z.dosages)"""


_QTY = "CAST(replace(replace(cantidad, '.', ''), ',', '.') AS DECIMAL(38,6))"
CASCADE = rf"""WITH {ctes('v_contract', 'v_deliveries')}, {_parsed('pt', 'v_contract')}, {_parsed('pe', 'v_deliveries')}, {_list('a', 'PRIMARY', 'pe')}, {_list('b', 'SECONDARY', 'pe')},
m AS (SELECT a.d, a.form, CASE WHEN u THEN b.status ELSE a.status END AS status, CASE WHEN u THEN b.target ELSE a.target END AS target,
      CASE WHEN u THEN b.descripcion_target ELSE a.descripcion_target END AS descripcion_target, CASE WHEN u THEN b.codigo_target ELSE a.codigo_target END AS codigo_target,
      CASE WHEN u THEN b.observacion ELSE a.observacion END AS observacion, CASE WHEN u THEN 'SECONDARY' ELSE 'PRIMARY' END AS fuente
      FROM (SELECT *, a.status = '{voc.NOT_FOUND}' AND (SELECT status FROM b_m WHERE b_m.d = a.d) <> '{voc.NOT_FOUND}' AS u FROM a_m a) a JOIN b_m b ON a.d = b.d),
k AS (SELECT e.mes, e.descripcion, e.codigo, {_QTY} AS cantidad, m.* EXCLUDE (d), m.status IN ('{voc.EXACT}', '{voc.PRESENTATION}') AS valido FROM v_deliveries e JOIN m ON m.d = e.descripcion)
"""


def _events(v: Views) -> DataFrame:
    return v.deliveries.withColumn("cantidad", num.parse_colombian(F.col("cantidad")).cast(num.QUANTITY))


def _classified(v: Views) -> DataFrame:
    return matching.classify(_events(v), v.primary, v.secondary)


def _joined(c: str):
    return F.array_join(c, ";").alias(c)


def _doses(c: str = "dosages"):
    return F.array_join(F.transform(c, lambda x: x.cast("decimal(18,3)").cast("string")), ";").alias(c)


_DOSES = "array_to_string(list_transform(dosages, lambda x: CAST(CAST(x AS DECIMAL(18,3)) AS VARCHAR)), ';') AS dosages"


@query(f"WITH {ctes('v_deliveries')} SELECT DISTINCT descripcion, {_normal('descripcion')} AS normal FROM v_deliveries")
def normalize_text(v: Views) -> DataFrame:
    return v.deliveries.select("descripcion").distinct().withColumn("normal", tx.normalize_description(F.col("descripcion")))


@query()
def normalize_documents(v: Views) -> DataFrame:
    """The same over texts in several scripts, with the full folding beside it."""
    text = F.col("text")
    return v.table("documents").select("doc_id", F.md5(tx.normalize_description(text)).alias("normal"), F.md5(tx.remove_accents_full(text)).alias("plegado"), F.md5(tx.key_robust(text)).alias("robusta"))


@query(f"WITH {ctes('v_deliveries')}, {_parsed('p', 'v_deliveries')} SELECT d AS descripcion, form FROM p")
def parse_form(v: Views) -> DataFrame:
    return medication.parse_distinct(v.deliveries, "descripcion").select("descripcion", "form")


@query(f"WITH {ctes('v_deliveries')}, {_parsed('p', 'v_deliveries')} SELECT d AS descripcion, {_DOSES} FROM p")
def parse_dosages(v: Views) -> DataFrame:
    return medication.parse_distinct(v.deliveries, "descripcion").select("descripcion", _doses())


@query(f"WITH {ctes('v_deliveries')}, {_parsed('p', 'v_deliveries')} SELECT d AS descripcion, array_to_string(components, ';') AS components FROM p")
def parse_components(v: Views) -> DataFrame:
    return medication.parse_distinct(v.deliveries, "descripcion").select("descripcion", _joined("components"))


def _one_list(v: Views, step) -> DataFrame:
    return step(medication.parse_distinct(v.deliveries, "descripcion"), matching.target_index(v.primary))


_ONE = f"WITH {ctes('v_contract', 'v_deliveries')}, {_parsed('pt', 'v_contract')}, {_parsed('pe', 'v_deliveries')}, {_list('a', 'PRIMARY', 'pe')}"


@query(_ONE + "SELECT e.d AS descripcion, x.o AS ordinal FROM pe e JOIN a_e x ON e.components = x.components AND e.dosages = x.dosages AND e.form = x.form")
def match_exact(v: Views) -> DataFrame:
    return _one_list(v, matching.match_exact).where("exact is not null").select("descripcion", "exact.ordinal")


@query(_ONE + "SELECT e.d AS descripcion, x.o AS ordinal, x.of AS forma_contrato FROM pe e JOIN a_p x ON e.components = x.components AND e.dosages = x.dosages")
def match_presentation(v: Views) -> DataFrame:
    return _one_list(v, matching.match_presentation).where("presentation is not null").select("descripcion", "presentation.ordinal", F.col("presentation.form").alias("forma_contrato"))


@query(_ONE + "SELECT e.d AS descripcion, x.sd AS sugerido, array_to_string(x.common, ';') AS common FROM pe e JOIN a_s x ON e.components = x.components AND e.dosages = x.dosages")
def match_substitution(v: Views) -> DataFrame:
    return _one_list(v, matching.match_substitution).where("substitute is not null").select("descripcion", F.col("substitute.descripcion").alias("sugerido"), _joined("common"))


@query(CASCADE + "SELECT d AS descripcion, status, target, descripcion_target, codigo_target, observacion, fuente FROM m")
def match_cascade(v: Views) -> DataFrame:
    return matching.match_cascade(v.deliveries, v.primary, v.secondary).select("descripcion", *matching.MATCH, "fuente")


@query(
    CASCADE
    + f"""SELECT mes AS archivo, descripcion AS descripcion_original, codigo AS codigo_original, status AS estado_match,
  CASE WHEN valido THEN coalesce(descripcion_target, '') WHEN status = '{voc.SUBSTITUTION}' THEN observacion ELSE '' END AS producto_contrato_sugerido,
  CASE WHEN valido THEN coalesce(codigo_target, '') ELSE '' END AS codigo_contrato_sugerido,
  CASE status WHEN '{voc.EXACT}' THEN '100.0' WHEN '{voc.PRESENTATION}' THEN '90.0' ELSE '0.0' END AS score,
  CASE status {" ".join(f"WHEN '{k}' THEN '{m}'" for k, m in voc.METHODS.items())} END AS metodo, CASE WHEN valido THEN fuente ELSE '-' END AS fuente,
  observacion AS observaciones_auditoria, CASE WHEN status = '{voc.SUBSTITUTION}' THEN 'SI' ELSE '' END AS posible_sustituto FROM k"""
)
def audit_log(v: Views) -> DataFrame:
    return matching.audit_log(_classified(v))


@query(CASCADE + "SELECT mes AS archivo, descripcion AS descripcion_original, codigo AS codigo_original, cantidad::DOUBLE AS cantidad, status AS estado, observacion FROM k WHERE NOT valido")
def unmatched(v: Views) -> DataFrame:
    return matching.unmatched(_classified(v)).withColumn("cantidad", F.col("cantidad").cast("double"))


_PLACED = CASCADE.replace("SELECT e.mes,", "SELECT e.l_orderkey, e.l_linenumber, e.l_partkey, e.mes,")


@query(
    _PLACED
    + "SELECT descripcion AS descripcion_original, sum(cantidad)::DOUBLE AS cantidad, arg_min(codigo, (l_orderkey, l_linenumber, l_partkey)) AS codigo_original FROM k WHERE NOT valido GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50"
)
def top_missing_50(v: Views) -> DataFrame:
    """With the first code of each by order."""
    events = _events(v).withColumn("orden", F.struct("l_orderkey", "l_linenumber", "l_partkey"))
    return matching.top_missing(matching.classify(events, v.primary, v.secondary)).withColumn("cantidad", F.col("cantidad").cast("double"))


_COVER = "sum(cantidad)::DOUBLE AS total, coalesce(sum(cantidad) FILTER (valido), 0)::DOUBLE AS cruzado, round(coalesce(sum(cantidad) FILTER (valido), 0)::DOUBLE / sum(cantidad)::DOUBLE * 100, 6) AS cobertura"


def _coverage(df: DataFrame) -> DataFrame:
    return df.withColumns({"total": F.col("total").cast("double"), "cruzado": F.col("cruzado").cast("double"), "cobertura": F.round("cobertura", 6)})


@query(CASCADE + f"SELECT mes, {_COVER} FROM k GROUP BY mes")
def coverage_by_month(v: Views) -> DataFrame:
    return _coverage(matching.coverage(_classified(v), ["mes"]))


@query(CASCADE + f"SELECT {_COVER} FROM k")
def coverage_total(v: Views) -> DataFrame:
    return _coverage(matching.coverage(_classified(v), []))


@query(CASCADE + "SELECT fuente, target, mes, sum(cantidad)::DOUBLE AS cantidad FROM k WHERE valido AND target IS NOT NULL GROUP BY ALL")
def matched_quantity(v: Views) -> DataFrame:
    return matching.matched_quantities(_classified(v)).withColumn("cantidad", F.col("cantidad").cast("double"))


_SHOWN = r"replace(regexp_replace(regexp_replace(CAST({q} AS VARCHAR), '(\.\d*?)0+$', '\1'), '\.$', ''), '.', ',')"
_WIDE = ", ".join(f"CASE WHEN sum(cantidad) FILTER (mes = '{m}') > 0 THEN {_SHOWN.format(q=f"(sum(cantidad) FILTER (mes = '{m}'))::DECIMAL(38,6)")} ELSE '0' END AS \"{m}\"" for m in sorted(MONTHS))
_PIVOT = f"w AS (SELECT fuente, target, {_WIDE}, {_SHOWN.format(q='sum(cantidad)::DECIMAL(38,6)')} AS total FROM k WHERE valido AND target IS NOT NULL GROUP BY fuente, target)"
_COLUMNS = ", ".join(f'w."{m}"' for m in sorted(MONTHS))


@query(CASCADE + f", {_PIVOT} SELECT w.fuente AS fuente_match, target, c.descripcion AS descripcion_target, c.codigo AS codigo_target, {_COLUMNS}, total AS total_acumulado FROM w JOIN v_contract c ON c.ordinal = target")
def pivot_by_month(v: Views) -> DataFrame:
    return consolidation.match_report(matching.matched_quantities(_classified(v)), v.contract, MONTHS)


@query(
    CASCADE
    + f""", {_PIVOT} SELECT c.fuente AS fuente_lista, c.ordinal AS indice_original, c.descripcion AS descripcion_master, c.codigo AS codigo_master,
  {", ".join(f'''coalesce(w."{m}", '0') AS "{m}"''' for m in sorted(MONTHS))}, coalesce(total, '0') AS total_general FROM v_contract c LEFT JOIN w ON w.target = c.ordinal AND w.fuente = c.fuente"""
)
def master_sheet(v: Views) -> DataFrame:
    return consolidation.master_sheet(matching.matched_quantities(_classified(v)), v.contract, MONTHS)


@query(f"WITH {ctes('v_contract')} SELECT count(*)::BIGINT AS esperados, count(*)::BIGINT AS reales FROM v_contract")
def master_sheet_check(v: Views) -> DataFrame:
    return consolidation.sheet_check(v.primary, v.secondary, master_sheet(v))


def _raw(v: Views) -> DataFrame:
    return v.deliveries.select(F.col("descripcion").alias("descripcion_original"), "cantidad", F.col("mes").alias("mes_entrega"))


def _lab(canonical: bool) -> str:
    part = "upper(trim(string_split(d, '|')[2]))"
    keyword = " ".join(f"WHEN contains(upper(d), '{k}') THEN '{v}'" for k, v in voc.LAB_KEYWORDS.items())
    known = "CASE " + " ".join(f"WHEN {part} = '{k}' THEN '{v}'" for k, v in voc.LAB_KEYWORDS.items()) + f" ELSE {part} END" if canonical else part
    return f"CASE WHEN coalesce({part}, '') <> '' THEN {known} {keyword} ELSE '{voc.NO_LAB}' END"


_STANDARD = rf"trim(regexp_replace(regexp_replace(regexp_replace(upper(strip_accents(d)), '[^A-Z0-9\s.%]', ' ', 'g'), '(\d)\s+({'|'.join(voc.STANDARD_UNITS)})\b', '\1\2', 'g'), '\s+', ' ', 'g'))"
_KEY = rf"CASE WHEN q IS NULL OR q = 0 OR coalesce(d, '') = '' OR {_STANDARD} = '' OR NOT regexp_matches({_STANDARD}, '(?:^|[\s\d])(?:{'|'.join(voc.STANDARD_UNITS)})\b') THEN '{voc.TO_REVIEW}' ELSE {_STANDARD} END"
_RAW = f"WITH {ctes('v_deliveries')}, r AS (SELECT descripcion AS d, CAST(replace(replace(cantidad, '.', ''), ',', '.') AS DOUBLE) AS q, mes FROM v_deliveries)"


@query(f"{_RAW} SELECT DISTINCT d AS descripcion_original, {_lab(False)} AS laboratorio, {_lab(True)} AS laboratorio_estandar FROM r")
def lab_extract(v: Views) -> DataFrame:
    d = F.col("descripcion_original")
    return _raw(v).select("descripcion_original").distinct().withColumns({"laboratorio": tx.extract_lab(d), "laboratorio_estandar": tx.extract_lab_canonical(d)})


@query(f"{_RAW} SELECT DISTINCT d AS descripcion_original, {_KEY} AS llave_de_cruce FROM r")
def standard_key(v: Views) -> DataFrame:
    return consolidation.sanitize(_raw(v)).select("descripcion_original", "llave_de_cruce").distinct()


@query(f"{_RAW} SELECT {_KEY} AS medicamento_estandarizado, {_lab(False)} AS laboratorio, sum(q) AS cantidad_total_entregada, count(*)::BIGINT AS numero_de_entregas_asociadas FROM r GROUP BY 1, 2")
def consolidate_v1(v: Views) -> DataFrame:
    return consolidation.consolidate(consolidation.sanitize(_raw(v)))


@query(f"{_RAW} SELECT mes AS archivo, count(*)::BIGINT AS total_registros, sum(q) AS suma_cantidades FROM r GROUP BY mes")
def file_audit(v: Views) -> DataFrame:
    return consolidation.file_audit(consolidation.sanitize(_raw(v)))


@query(f"{_RAW}, g AS (SELECT sum(q) AS s FROM r GROUP BY {_KEY}, {_lab(False)}) SELECT *, abs(entrada - salida) < 0.01 AS integro FROM (SELECT (SELECT sum(q) FROM r) AS entrada, (SELECT sum(s) FROM g) AS salida)")
def integrity_check(v: Views) -> DataFrame:
    rows = consolidation.sanitize(_raw(v))
    return consolidation.integrity(rows, "cantidad", consolidation.consolidate(rows), "cantidad_total_entregada")


_CATALOG_KEY = "upper(strip_accents({c}))"
for _short, _full in voc.CATALOG_FORMS.items():
    _CATALOG_KEY = rf"regexp_replace({_CATALOG_KEY}, '\b{_short}\b', '{_full}', 'g')"
_CATALOG_KEY = rf"trim(regexp_replace(regexp_replace({_CATALOG_KEY}, '(\d)\s+({'|'.join(voc.CATALOG_UNITS)})\b', '\1\2', 'g'), '\s+', ' ', 'g'))"


def _named(v: Views) -> DataFrame:
    """Deliveries with the catalog spelling as product (catalog matching apart)."""
    return consolidation.sanitize_catalog(_raw(v)).withColumn("producto_oficial", F.col("llave_cruce"))


@query(
    f"{_RAW} SELECT mes, {_CATALOG_KEY.format(c="string_split(d, '|')[1]")} AS producto_oficial, {_lab(True)} AS laboratorio, sum(q) AS total_unidades, count(*)::BIGINT AS numero_de_entregas FROM r GROUP BY 1, 2, 3"
)
def consolidate_v2(v: Views) -> DataFrame:
    return consolidation.consolidate_catalog(_named(v))


@query(
    f"WITH {ctes('v_contract', 'v_deliveries')}, e AS (SELECT DISTINCT {_CATALOG_KEY.format(c="string_split(descripcion, '|')[1]")} AS k FROM v_deliveries), c AS (SELECT DISTINCT {_CATALOG_KEY.format(c='descripcion')} AS llave FROM v_contract) "
    f"SELECT length(k)::INT AS largo, count(*)::BIGINT AS pares FROM e JOIN c ON length(k) BETWEEN ceil({catalog.CUTOFF} * length(llave) / (2 - {catalog.CUTOFF})) AND floor(length(llave) * (2 - {catalog.CUTOFF}) / {catalog.CUTOFF}) WHERE k <> '' GROUP BY 1"
)
def fuzzy_candidates(v: Views) -> DataFrame:
    keys = catalog.catalog_keys(v.contract, "descripcion")
    return catalog.candidates(consolidation.sanitize_catalog(_raw(v)), keys).groupBy(F.length("llave_cruce").alias("largo")).agg(F.count("*").alias("pares"))


@query()
def catalog_fuzzy(v: Views) -> DataFrame:
    """Every delivered product against a catalog of official names."""
    keys = catalog.catalog_keys(v.table("part").select(F.col("p_partkey").alias("ordinal"), F.concat(F.upper("p_name"), F.lit(" TABLETA")).alias("nombre")), "nombre")
    named = v.table("part").select(F.concat(F.upper("p_name"), F.when(F.col("p_partkey") % 2 == 0, " TAB").otherwise(" TABLETAS X")).alias("descripcion_original"), F.lit("1").alias("cantidad"), F.lit("1mes").alias("mes_entrega"))
    return catalog.match_catalog(consolidation.sanitize_catalog(named), keys)


_V = f"WITH {ctes('v_consolidated')}"
_M = "(CAST(regexp_extract(mes, '^(\\d+)', 1) AS INT))"
_MN = f"CASE {_M} " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(voc.MONTHS, 1)) + " END"


@query(f"{_V} SELECT row_number() OVER (ORDER BY u DESC, producto_oficial) AS ranking, producto_oficial, u AS total_unidades, f AS frecuencia_entregas FROM (SELECT producto_oficial, sum(total_unidades) AS u, sum(numero_de_entregas)::BIGINT AS f FROM v_consolidated GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50)")
def rank_top50_global(v: Views) -> DataFrame:
    return reports.rank_products(v.consolidated)


@query(
    f"{_V} SELECT * FROM (SELECT mes_orden, mes_nombre, producto_oficial, u AS total_unidades, f AS frecuencia_entregas, row_number() OVER (PARTITION BY mes_orden ORDER BY u DESC, producto_oficial) AS ranking "
    f"FROM (SELECT {_M} AS mes_orden, {_MN} AS mes_nombre, producto_oficial, sum(total_unidades) AS u, sum(numero_de_entregas)::BIGINT AS f FROM v_consolidated GROUP BY 1, 2, 3)) WHERE ranking <= 50"
)
def rank_top50_monthly(v: Views) -> DataFrame:
    return reports.rank_products_monthly(v.consolidated)


@query(
    f"{_V}, g AS (SELECT producto_oficial, sum(total_unidades) AS u FROM v_consolidated GROUP BY 1), t AS (SELECT * FROM g ORDER BY u DESC, producto_oficial LIMIT 30) "
    "SELECT row_number() OVER o AS ranking, producto_oficial, u AS total_unidades, sum(u) OVER o AS acumulado, round(sum(u) OVER o / (SELECT sum(u) FROM g) * 100, 6) AS porcentaje_acumulado FROM t WINDOW o AS (ORDER BY u DESC, producto_oficial)"
)
def pareto_30(v: Views) -> DataFrame:
    return reports.pareto(v.consolidated).withColumn("porcentaje_acumulado", F.round("porcentaje_acumulado", 6))


@query(
    f"{_V}, g AS (SELECT laboratorio, sum(total_unidades) AS u FROM v_consolidated GROUP BY 1), t AS (SELECT * FROM g ORDER BY u DESC, laboratorio LIMIT 10), "
    "a AS (SELECT * FROM t UNION ALL SELECT 'OTROS', (SELECT sum(u) FROM g) - (SELECT sum(u) FROM t)) SELECT laboratorio, u AS total_unidades, round(u / (SELECT sum(u) FROM g) * 100, 6) AS participacion FROM a WHERE u > 0"
)
def lab_share(v: Views) -> DataFrame:
    return reports.lab_share(v.consolidated).withColumn("participacion", F.round("participacion", 6))


@query(f"{_V} SELECT {_M} AS mes_orden, {_MN} AS mes_nombre, sum(total_unidades) AS total_unidades, sum(numero_de_entregas)::BIGINT AS numero_de_entregas FROM v_consolidated GROUP BY 1, 2")
def monthly_evolution(v: Views) -> DataFrame:
    return reports.monthly_evolution(v.consolidated)


@query(
    f"{_V}, g AS (SELECT {_M} AS o, {_MN} AS m, sum(total_unidades) AS u, sum(numero_de_entregas)::BIGINT AS n FROM v_consolidated GROUP BY 1, 2) "
    "SELECT sum(u) AS total_unidades, sum(n)::BIGINT AS total_entregas, round(sum(u) / sum(n), 6) AS promedio, arg_min(m, o) AS mes_inicial, arg_max(m, o) AS mes_final, round((arg_max(u, o) - arg_min(u, o)) / arg_min(u, o) * 100, 6) AS variacion FROM g"
)
def kpi(v: Views) -> DataFrame:
    return reports.indicators(v.consolidated).withColumns({"promedio": F.round("promedio", 6), "variacion": F.round("variacion", 6)})


_NAMES = f"WITH {ctes('v_consolidated')}, n AS (SELECT DISTINCT mes FROM v_consolidated UNION SELECT '13x' UNION SELECT 'abril')"


@query(f"{_NAMES} SELECT mes, coalesce(TRY_CAST(nullif(regexp_extract(mes, '^(\\d+)', 1), '') AS INT), 99) AS orden, CASE WHEN mes = '13x' THEN 'MES_13' WHEN mes = 'abril' THEN mes ELSE {_MN.replace('(CAST(', '(TRY_CAST(')} END AS nombre FROM n")
def parse_month(v: Views) -> DataFrame:
    extra = v.spark.createDataFrame([("13x",), ("abril",)], "mes string")
    return v.consolidated.select("mes").distinct().union(extra).select("mes", num.month_order(F.col("mes")).alias("orden"), num.month_name(F.col("mes")).alias("nombre"))


def _spelt(v: Views) -> DataFrame:
    return v.deliveries.select(F.explode(F.array(*[F.expr(x) for x in _SPELLINGS])).alias("cantidad")).distinct()


#: Spellings of the deliveries' quantities in which the two grammars differ.
_SPELLINGS = ("cantidad", "replace(replace(replace(cantidad, '.', '#'), ',', '.'), '#', ',')", "replace(cantidad, ',00', '')", "replace(cantidad, '.', '')", "'$ ' || replace(cantidad, ',', '.')", "cantidad || 'x'")
_SPELT = " UNION ".join(f"SELECT {x} AS cantidad FROM v_deliveries" for x in _SPELLINGS)
_PLAIN = "replace(replace(cantidad, '$', ''), ' ', '')"


@query(
    f"WITH {ctes('v_deliveries')}, s AS ({_SPELT}), p AS (SELECT cantidad, {_PLAIN} AS x FROM s) SELECT cantidad, coalesce(TRY_CAST(CASE WHEN contains(x, ',') AND contains(x, '.') "
    "THEN CASE WHEN instr(x, '.') < instr(x, ',') THEN replace(replace(x, '.', ''), ',', '.') ELSE replace(x, ',', '') END ELSE replace(x, ',', '.') END AS DOUBLE), 0) AS cantidad_decimal FROM p"
)
def quantity_decimal(v: Views) -> DataFrame:
    return _spelt(v).withColumn("cantidad_decimal", num.parse_decimal(F.col("cantidad")).cast("double"))


@query(f"WITH {ctes('v_deliveries')}, s AS ({_SPELT}) SELECT cantidad, coalesce(TRY_CAST(replace(replace(cantidad, '.', ''), ',', '.') AS DOUBLE), 0) AS cantidad_num FROM s")
def quantity_colombian(v: Views) -> DataFrame:
    return _spelt(v).withColumn("cantidad_num", num.parse_colombian(F.col("cantidad")))


_CUT = "CASE WHEN regexp_matches({c}, '[\\s\\-:]*\\$?\\s*\\d{{1,3}}(?:[.,]\\d{{3}})*(?:[.,]\\d+)?\\s*$') THEN rtrim(regexp_replace({c}, '[\\s\\-:]*\\$?\\s*\\d{{1,3}}(?:[.,]\\d{{3}})*(?:[.,]\\d+)?\\s*$', '')) ELSE {c} END"
_ROBUST = "lower(trim(regexp_replace({c}, '\\s+', ' ', 'g')))"


def _keys(alias: str) -> str:
    c = f"{alias}.descripcion"
    cut = _CUT.format(c=c)
    names = {"exact": c, "trim": f"trim({c})", "strip_trim": f"trim({cut})", "casefold": f"lower(trim({c}))", "robust": _ROBUST.format(c=c), "strip_robust": _ROBUST.format(c=cut)}
    return ", ".join(f"{k} AS k_{n}" for n, k in names.items())


_RULED = (
    f"WITH {ctes('v_costs', 'v_price_targets')}, t AS (SELECT ordinal, descripcion, {_keys('x')} FROM v_price_targets x), c AS (SELECT ordinal AS o, costo, {_keys('y')} FROM v_costs y), h AS ("
    + " UNION ALL ".join(f"SELECT {i} AS rule, '{label}' AS metodo, t.ordinal, c.costo FROM t JOIN c ON t.k_{a} = c.k_{b}" for i, (label, a, b) in enumerate(prices.RULES))
    + ") "
)


@query(_RULED + "SELECT t.ordinal, t.descripcion, arg_min(h.costo, h.rule) AS precio_encontrado, arg_min(h.metodo, h.rule) AS metodo_coincidencia FROM t JOIN h USING (ordinal) GROUP BY 1, 2")
def price_rules_1_9(v: Views) -> DataFrame:
    found = prices.match_rules(v.price_targets, v.costs)
    label = F.coalesce(*[F.when(F.col("rule") == i, F.lit(name)) for i, (name, _, _) in enumerate(prices.RULES)])
    return v.price_targets.join(found, "descripcion").select("ordinal", "descripcion", F.col("costo").alias("precio_encontrado"), label.alias("metodo_coincidencia"))


@query()
def price_lookup(v: Views) -> DataFrame:
    return prices.look_up(v.price_targets, v.costs).withColumn("similitud", F.round("similitud", 6))


@query()
def price_fallback(v: Views) -> DataFrame:
    open_ = v.price_targets.join(prices.match_rules(v.price_targets, v.costs).select("descripcion"), "descripcion", "left_anti")
    return prices.match_similar(open_, v.costs).withColumn("similitud", F.round("similitud", 6))


@query()
def price_top3(v: Views) -> DataFrame:
    looked_up = prices.look_up(v.price_targets, v.costs, threshold=0.999)
    return prices.nearest_costs(looked_up, v.costs).withColumn("similitud", F.round("similitud", 6))


@query(_RULED + "SELECT (SELECT count(DISTINCT ordinal) FROM h)::BIGINT AS encontrados, ((SELECT count(*) FROM t) - (SELECT count(DISTINCT ordinal) FROM h))::BIGINT AS no_encontrados")
def price_counts(v: Views) -> DataFrame:
    """Found and not found by rules alone."""
    found = v.price_targets.join(prices.match_rules(v.price_targets, v.costs), "descripcion", "left")
    return prices.summary(found.withColumn("metodo_coincidencia", F.when(F.col("rule").isNull(), F.lit(prices.NOT_FOUND)).otherwise("regla")))


_CODED = "regexp_replace(w, '[^BFPVCGJKQSXZDTLMNR]', '', 'g')"
_DIGIT = f"translate({_CODED}, 'BFPVCGJKQSXZDTLMNR', '111122222222334556')"
for _d in "123456":
    _DIGIT = f"regexp_replace({_DIGIT}, '{_d}+', '{_d}', 'g')"
_PHONETIC = f"CASE WHEN w = '' THEN '' ELSE substr(rpad(substr(w, 1, 1) || CASE WHEN regexp_matches(w, '^[BFPVCGJKQSXZDTLMNR]') THEN substr({_DIGIT}, 2) ELSE {_DIGIT} END, 4, '0'), 1, 4) END"
_WORDS = rf"(SELECT DISTINCT unnest(regexp_split_to_array({_normal('p_name')}, '\s+')) AS w FROM part)"


@query(f"SELECT w AS palabra, {_PHONETIC} AS codigo FROM {_WORDS}")
def phonetic_code(v: Views) -> DataFrame:
    words = v.table("part").select(F.explode(F.split(tx.normalize_description(F.col("p_name")), r"\s+")).alias("palabra")).distinct()
    return words.withColumn("codigo", phonetic.phonetic_code(F.col("palabra")))


_FEATURES = r"list_sort(list_distinct(list_concat(list_transform(regexp_extract_all(t, '\b(\d+(?:[.,]\d+)?)\s+(?:(?:MG|MCG|G|UI|IU|GR|ML)\b|%)', 1), lambda x: CAST(x AS DOUBLE)), list_transform(regexp_extract_all(t, '\b(\d+(?:[.,]\d+)?)\s+%', 1), lambda x: CAST(x AS DOUBLE) * 10))))"
_SPACED = r"regexp_replace(descripcion, '(\d)(MG)', '\1 \2', 'g')"
_FEAT = "array_to_string(list_transform({f}, lambda x: CAST(CAST(x AS DECIMAL(18,3)) AS VARCHAR)), ';')"


@query(f"WITH {ctes('v_contract')}, s AS (SELECT DISTINCT descripcion, {_SPACED} AS t FROM v_contract) SELECT descripcion, {_FEAT.format(f=_FEATURES)} AS numeros FROM s")
def feature_numbers(v: Views) -> DataFrame:
    spaced = F.regexp_replace("descripcion", r"(\d)(MG)", "$1 $2")
    rows = v.contract.select("descripcion").distinct().withColumn("numeros", phonetic.numeric_features(spaced))
    return rows.select("descripcion", _doses("numeros"))


@query(
    f"WITH {ctes('v_contract')}, s AS (SELECT ordinal, {_FEATURES.replace('(t,', f'({_SPACED},')} AS f FROM v_contract) "
    "SELECT a.ordinal, CASE WHEN len(a.f) = 0 OR len(b.f) = 0 OR list_has_any(a.f, b.f) THEN 1.0 ELSE 0.0 END::DOUBLE AS compatible FROM s a JOIN s b ON b.ordinal = a.ordinal + 1"
)
def feature_compat(v: Views) -> DataFrame:
    rows = v.contract.select("ordinal", phonetic.numeric_features(F.regexp_replace("descripcion", r"(\d)(MG)", "$1 $2")).alias("f"))
    other = rows.select((F.col("ordinal") - 1).alias("ordinal"), F.col("f").alias("g"))
    return rows.join(other, "ordinal").select("ordinal", phonetic.features_compatible(F.col("f"), F.col("g")).alias("compatible"))


_FIRST = rf"list_filter(regexp_split_to_array(replace(upper(descripcion), '.', ' '), '\s+'), lambda w: NOT regexp_full_match(w, '\d+[.,]?\d*') AND length(w) >= 3 AND NOT list_contains([{_quoted(voc.STOP_WORDS)}], w))[1]"


@query(
    f"WITH {ctes('v_contract')}, f AS (SELECT ordinal, {_FIRST} AS w FROM v_contract), p AS (SELECT ordinal, w, {_PHONETIC} AS c FROM f) "
    "SELECT a.ordinal, a.w IS NULL OR b.w IS NULL OR a.w = b.w OR (length(a.w) >= 4 AND length(b.w) >= 4 AND a.c = b.c) AS coincide FROM p a JOIN p b ON b.ordinal = a.ordinal + 1"
)
def token_match_exact_or_phonetic(v: Views) -> DataFrame:
    rows = v.contract.select("ordinal", "descripcion")
    other = rows.select((F.col("ordinal") - 1).alias("ordinal"), F.col("descripcion").alias("otra"))
    return rows.join(other, "ordinal").select("ordinal", phonetic.first_word_matches(F.col("descripcion"), F.col("otra"), fuzzy=False).alias("coincide"))


_NOISE = "|".join(sorted(voc.LAB_NOISE, key=lambda n: (-len(n), n)))
_CLEAN = rf"strip_accents(regexp_replace(string_split(upper(d), '|')[1], '\b({_NOISE})\b', '', 'gi'))"
_CLEAN = rf"regexp_replace(regexp_replace(replace({_CLEAN}, ',', '.'), '(\d)\s*([A-Z%]+)', '\1 \2', 'g'), '([A-Z%]+)\s*(\d)', '\1 \2', 'g')"
_EXPANDED = "CASE w " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in voc.ABBREVIATIONS.items()) + " ELSE w END"


@query(
    f"WITH {ctes('v_deliveries')}, t AS (SELECT DISTINCT descripcion AS d FROM v_deliveries) SELECT d AS descripcion, array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_replace({_CLEAN}, "
    rf"'[^A-Z0-9\s.%]', ' ', 'g'), '\s+'), lambda w: {_EXPANDED}), lambda w: w <> ''), ' ') AS limpio, regexp_replace(d, '\d+', '', 'g') AS sin_numeros, regexp_replace(d, '\b({_NOISE})\b', '', 'gi') AS sin_laboratorio FROM t"
)
def clean_text(v: Views) -> DataFrame:
    """Deep cleaning of delivered descriptions, and two of its parts alone."""
    d = F.col("descripcion")
    return v.deliveries.select("descripcion").distinct().withColumns({"limpio": tx.clean_text(d), "sin_numeros": tx.remove_numbers(d), "sin_laboratorio": tx.strip_labs(d)})


@query()
def token_match(v: Views) -> DataFrame:
    """First significant words that are equal, alike or sound alike, and the likeness of the whole descriptions."""
    rows = v.contract.select("ordinal", "descripcion")
    other = rows.select((F.col("ordinal") - 1).alias("ordinal"), F.col("descripcion").alias("otra"))
    both = rows.join(other, "ordinal")
    return both.select("ordinal", "descripcion", "otra", phonetic.first_word_matches(F.col("descripcion"), F.col("otra")).alias("coincide"), F.round(similarity.indel_ratio("descripcion", "otra"), 6).alias("parecido"))


@query()
def price_summary(v: Views) -> DataFrame:
    """Found and not found by rules and similarity."""
    return prices.summary(prices.look_up(v.price_targets, v.costs))


@query()
def price_preview(v: Views) -> DataFrame:
    return prices.look_up_first(v.price_targets, v.costs).withColumn("similitud", F.round("similitud", 6))


def _catalog(v: Views) -> DataFrame:
    return catalog.catalog_keys(v.contract, "descripcion")


@query()
def consolidate_named(v: Views) -> DataFrame:
    """Units by month, official product (matched to the contract as catalog) and laboratory."""
    return consolidation.consolidate_catalog(consolidation.with_catalog(consolidation.sanitize_catalog(_raw(v)), _catalog(v)))


@query()
def file_audit_matched(v: Views) -> DataFrame:
    """Rows, quantity and share of matched rows of each file."""
    named = consolidation.with_catalog(consolidation.sanitize_catalog(_raw(v)), _catalog(v))
    return consolidation.file_audit(named, "cantidad_num", "match_found").withColumn("coincidencia", F.round("coincidencia", 6))


# Sources: the tables are written as files of several formats and read back.


@query(f"WITH {ctes('v_deliveries')} SELECT mes, descripcion, codigo, cantidad FROM v_deliveries")
def read_events(v: Views) -> DataFrame:
    """Audit files found by their names, with separator, encoding and columns detected; a result of an earlier run is no event file."""
    paths = files.discover_events(v.spark, v.event_files())
    return files.load_events(v.spark, paths)[0].select("mes", "descripcion", "codigo", "cantidad")


@query(
    f"WITH {ctes('v_deliveries')} SELECT mes AS mes_entrega, mes, descripcion AS descripcion_original, codigo AS \"CUM\", cantidad, "
    "CASE WHEN CAST(replace(mes, 'mesEvento', '') AS INT) % 3 = 0 THEN CAST(l_orderkey AS VARCHAR) END AS pedido FROM v_deliveries"
)
def read_deliveries(v: Views) -> DataFrame:
    """Sanitizer files, by name; a column that only some files have is null in the others."""
    return files.load_deliveries(v.spark, files.list_files(v.spark, f"{v.event_files()}/*.csv"))[0]


@query(f"WITH {ctes('v_contract')} SELECT row_number() OVER (ORDER BY ordinal) - 1 AS ordinal, 'PRIMARY' AS fuente, descripcion, codigo FROM v_contract WHERE fuente = 'PRIMARY'")
def read_targets(v: Views) -> DataFrame:
    """A contract list with its rows' places."""
    path = v.list_file(v.primary.select("ordinal", F.col("codigo").alias("codigo_neg"), F.col("fuente").alias("descripcion_fuente"), "descripcion"), "\t")
    return files.load_targets(v.spark, path).select("ordinal", "fuente", "descripcion", "codigo")


_CATALOG_FILE = "regexp_replace(descripcion, ' [0-9]+MG', '')"


@query(
    f"WITH {ctes('v_contract')}, c AS (SELECT ordinal, {_CATALOG_FILE} AS n FROM v_contract), k AS (SELECT ordinal, n, {_CATALOG_KEY.format(c='n')} AS llave FROM c) "
    "SELECT llave, arg_max(n, ordinal) AS oficial, max(ordinal) AS ultimo FROM k GROUP BY llave"
)
def read_catalog(v: Views) -> DataFrame:
    """A catalog without a column of the usual name: the first one counts; of names with one key the last stays."""
    rows = files.load_catalog(v.spark, v.list_file(v.contract.select("ordinal", F.expr(_CATALOG_FILE).alias("articulo"), "codigo"), ";"))
    last = rows.withColumn("llave", tx.catalog_key(F.col("producto_genhospi"))).groupBy("llave").agg(F.max("ordinal").alias("ultimo"))
    return catalog.catalog_keys(rows).join(last, "llave")


@query(f"WITH {ctes('v_costs')} SELECT row_number() OVER (ORDER BY ordinal) - 1 AS ordinal, descripcion, costo FROM v_costs")
def read_costs(v: Views) -> DataFrame:
    """A price list whose columns are known by their places."""
    path = v.list_file(v.costs.select("ordinal", F.col("descripcion").alias("articulo"), F.col("costo").alias("valor")), "|", "ISO-8859-1")
    return files.load_costs(v.spark, path).select("ordinal", "descripcion", "costo")


@query(f"WITH {ctes('v_price_targets')} SELECT row_number() OVER (ORDER BY ordinal) - 1 AS ordinal, descripcion, CAST(ordinal AS VARCHAR) AS referencia FROM v_price_targets")
def read_price_targets(v: Views) -> DataFrame:
    rows = v.price_targets.select("ordinal", F.col("ordinal").cast("string").alias("referencia"), "descripcion")
    return files.load_price_targets(v.spark, v.list_file(rows, ";"))[0].select("ordinal", "descripcion", "referencia")


@query(f"WITH {ctes('v_consolidated')} SELECT mes, producto_oficial, laboratorio, total_unidades::DOUBLE AS total_unidades, numero_de_entregas::BIGINT AS numero_de_entregas FROM v_consolidated")
def read_consolidated(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "consolidated")
    sinks.write_csv(v.consolidated, path)
    return files.load_consolidated(v.spark, path)


@query(f"WITH {ctes('v_deliveries')} SELECT mes || '_LIMPIO' AS archivo, mes, descripcion, cantidad FROM v_deliveries")
def export_months(v: Views) -> DataFrame:
    """One file per month, read back under its name."""
    paths = sinks.write_months(v.deliveries.select("mes", "descripcion", "cantidad"), scratch_path(v.spark, "months"), "mes")
    return files.load_deliveries(v.spark, paths)[0].select(F.col("mes_entrega").alias("archivo"), "mes", F.col("descripcion_original").alias("descripcion"), "cantidad")


@query(
    f"{_V}, g AS (SELECT 'Global_Periodo' AS hoja, producto_oficial, sum(total_unidades) AS u FROM v_consolidated GROUP BY ALL UNION ALL SELECT {_MN} AS hoja, producto_oficial, sum(total_unidades) AS u FROM v_consolidated GROUP BY ALL) "
    "SELECT * FROM (SELECT hoja, producto_oficial, u AS total_unidades, row_number() OVER (PARTITION BY hoja ORDER BY u DESC, producto_oficial) AS ranking FROM g) WHERE ranking <= 50"
)
def workbook_sheets(v: Views) -> DataFrame:
    """All sheets of the ranking workbook."""
    out = None
    for name, sheet in sinks.ranking_sheets(v.consolidated).items():
        rows = sheet.select(F.lit(name).alias("hoja"), "producto_oficial", "total_unidades", "ranking")
        out = rows if out is None else out.unionByName(rows)
    return out


_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


_NUMBERED = f"(SELECT *, row_number() OVER (ORDER BY {', '.join(_ORDER)}) - 1 AS i FROM lineitem)"


@query(f"SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_shipdate, i AS indice, (i // 15000 + 1)::BIGINT AS parte FROM {_NUMBERED}")
def chunk_split(v: Views) -> DataFrame:
    return chunk_numbers(v.table("lineitem"), _ORDER).select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate", "indice", "parte")


_SHORT = ["l_orderkey", "l_linenumber"]


@query("SELECT (i // 15000 + 1)::BIGINT AS parte, count(*)::BIGINT AS filas, min(i) AS primera, max(i) AS ultima, min(l_orderkey) AS menor, max(l_orderkey) AS mayor FROM (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS i FROM lineitem) GROUP BY 1")
def chunk_ranges(v: Views) -> DataFrame:
    """Parts of an order with ties, numbered with all other columns beside."""
    numbered = chunk_numbers(v.table("lineitem"), _SHORT).groupBy("parte").agg(
        F.countDistinct("indice", *v.table("lineitem").columns).alias("filas"), F.min("indice").alias("primera"), F.max("indice").alias("ultima"), F.min("l_orderkey").alias("menor"), F.max("l_orderkey").alias("mayor")
    )
    return numbered


@query(f"SELECT l_orderkey, l_linenumber, l_extendedprice, i AS indice, (i // 15000 + 1)::BIGINT AS parte FROM {_NUMBERED}")
def split_file(v: Views) -> DataFrame:
    """Rows of a file numbered in its own order."""
    path = scratch_path(v.spark, "split")
    table = v.table("lineitem")
    n = max(1, int(v.spark.conf.get("spark.sql.shuffle.partitions")))
    table.repartitionByRange(n, *_ORDER).sortWithinPartitions(*_ORDER).write.option("header", True).csv(path)
    rows = files.number_file(v.spark, path)
    return rows.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in ("l_orderkey", "l_linenumber", "l_extendedprice")], "indice", "parte")
