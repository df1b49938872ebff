"""Deliveries, contract, costs and consolidated tables derived from part and lineitem.

One SQL text serves Spark (with DataFrames filled in) and the DuckDB oracle (as CTEs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch_path
from ..sources import sinks

CONTRACT = """
SELECT p_partkey AS ordinal, CASE WHEN p_partkey % 3 = 0 THEN 'SECONDARY' ELSE 'PRIMARY' END AS fuente,
       upper(p_name) || ' ' || CAST(p_size AS STRING) || 'MG ' ||
       CASE p_partkey % 4 WHEN 0 THEN 'TABLETA' WHEN 1 THEN 'CAPSULA' WHEN 2 THEN 'SOLUCION' ELSE 'AMPOLLA' END AS descripcion,
       p_brand AS codigo
FROM {part}
"""
DELIVERIES = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(month(l.l_shipdate) AS STRING) || 'mesEvento' AS mes,
       CASE (l.l_orderkey + l.l_linenumber) % 6
         WHEN 0 THEN c.descripcion
         WHEN 1 THEN upper(p.p_name) || ' ' || CAST(p.p_size AS STRING) || 'MG PARCHE'
         WHEN 2 THEN upper(p.p_name) || ' + CODEÍNA ' || CAST(p.p_size AS STRING) || 'MG TABLETA'
         WHEN 3 THEN upper(p.p_name) || ' ' || CAST(p.p_size + 1000 AS STRING) || 'MG TABLETA GENFAR'
         WHEN 4 THEN lower(c.descripcion)
         ELSE c.descripcion || ' | ' || p.p_brand || ' | MARCA' END AS descripcion,
       c.codigo,
       CASE WHEN l.l_linenumber = 1 THEN '1.' || lpad(CAST(CAST(l.l_quantity AS INT) AS STRING), 3, '0') || ',00'
            ELSE CAST(CAST(l.l_quantity AS INT) AS STRING) || ',00' END AS cantidad
FROM {lineitem} l JOIN {part} p ON p.p_partkey = l.l_partkey JOIN {v_contract} c ON c.ordinal = p.p_partkey
"""
COSTS = """
SELECT p_partkey AS ordinal,
       CASE p_partkey % 4
         WHEN 0 THEN upper(p_name) || ' R' || CAST(p_partkey AS STRING) || 'X'
         WHEN 1 THEN '  ' || upper(p_name) || ' R' || CAST(p_partkey AS STRING) || 'X '
         WHEN 2 THEN lower(upper(p_name) || ' R' || CAST(p_partkey AS STRING) || 'X')
         ELSE upper(p_name) || ' R' || CAST(p_partkey AS STRING) || 'X $1,500' END AS descripcion,
       CAST(p_retailprice AS STRING) AS costo
FROM {part}
"""
PRICE_TARGETS = """
SELECT p_partkey AS ordinal,
       upper(p_name) || ' R' || CAST(p_partkey AS STRING) || CASE WHEN p_partkey % 7 = 0 THEN 'Z' ELSE 'X' END AS descripcion
FROM {part}
"""
CONSOLIDATED = """
SELECT mes, upper(p.p_name) AS producto_oficial, p.p_brand AS laboratorio, sum(l.l_quantity) AS total_unidades, count(*) AS numero_de_entregas
FROM (SELECT l_partkey, l_quantity, CAST(month(l_shipdate) AS STRING) || 'mesEvento' AS mes FROM {lineitem}) l
JOIN {part} p ON p.p_partkey = l.l_partkey
GROUP BY mes, upper(p.p_name), p.p_brand
"""
MONTHS = [f"{m}mesEvento" for m in range(1, 13)]


#: Formats that event files come in, by the number of the month: separator, encoding and names of name and quantity.
FORMATS = ((";", "UTF-8", "nombre", "cantidad"), (",", "ISO-8859-1", "descripcion", "unidades"), ("|", "UTF-8", "Producto", "CANT"))


class Views:
    """The derived tables of one folder of base tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def contract(self) -> DataFrame:
        return self.spark.sql(CONTRACT, part=self.table("part"))

    @property
    def primary(self) -> DataFrame:
        return self.contract.where("fuente = 'PRIMARY'")

    @property
    def secondary(self) -> DataFrame:
        return self.contract.where("fuente = 'SECONDARY'")

    @property
    def deliveries(self) -> DataFrame:
        return self.spark.sql(DELIVERIES, part=self.table("part"), lineitem=self.table("lineitem"), v_contract=self.contract)

    @property
    def costs(self) -> DataFrame:
        return self.spark.sql(COSTS, part=self.table("part"))

    @property
    def price_targets(self) -> DataFrame:
        return self.spark.sql(PRICE_TARGETS, part=self.table("part"))

    @property
    def consolidated(self) -> DataFrame:
        return self.spark.sql(CONSOLIDATED, part=self.table("part"), lineitem=self.table("lineitem"))

    def event_files(self) -> str:
        """A folder with the deliveries as one file (a folder of parts) per month, in several formats, and a result of an earlier run."""
        folder = scratch_path(self.spark, "events")
        for i, (sep, encoding, name, quantity) in enumerate(FORMATS):
            rows = self.deliveries.where(F.expr(f"CAST(replace(mes, 'mesEvento') AS INT) % {len(FORMATS)} = {i}"))
            columns = [F.col("descripcion").alias(name), F.col("codigo").alias("CUM"), F.col("cantidad").alias(quantity), "mes", *[F.col("l_orderkey").cast("string").alias("pedido")] * (i == 0)]
            # a byte-order mark, a name with blanks: headers are cleaned
            sinks.write_folders(rows.select(*columns).withColumnRenamed("CUM", " CUM "), "mes", folder, "{}.csv", sep, mark=encoding == "UTF-8", encoding=encoding)
        sinks.write_csv(self.contract, f"{folder}/reporte_Evento.csv")
        return folder

    def list_file(self, rows: DataFrame, sep: str, encoding: str = "UTF-8") -> str:
        """A list (ordinal and others) as a file in the order of its ordinal, which it doesn't hold."""
        path = scratch_path(self.spark, "list")
        n = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        ordered = rows.repartitionByRange(n, "ordinal").sortWithinPartitions("ordinal").drop("ordinal")
        sinks.csv_writer(ordered, sep, False, encoding).csv(path)
        return path


def ctes(*names: str) -> str:
    """The views as DuckDB CTEs, those they need included."""
    texts = {"v_contract": CONTRACT, "v_deliveries": DELIVERIES, "v_costs": COSTS, "v_price_targets": PRICE_TARGETS, "v_consolidated": CONSOLIDATED}
    if "v_deliveries" in names and "v_contract" not in names:
        names = ("v_contract", *names)
    return ",\n".join(f"{n} AS ({texts[n].format(part='part', lineitem='lineitem', v_contract='v_contract').strip()})" for n in names)
