"""Writing of results: distributed folders, and small files with a byte-order mark."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reports import indicator_text, monthly_evolution, rank_products, rank_products_monthly
from ..scratch import hadoop_path

AUDIT_SEPARATOR, SANITIZER_SEPARATOR = ";", ","
SHEET_NAME = 31


def csv_writer(df: DataFrame, sep: str, mark: bool, encoding: str = "UTF-8"):
    """A writer of comma-separated parts; with `mark` each begins with a byte-order mark, which is the first name's first character."""
    if mark and df.columns:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    exact = df.write.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    return exact.mode("overwrite").option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("encoding", encoding)


def write_csv(df: DataFrame, path: str, sep: str = SANITIZER_SEPARATOR, mark: bool = True) -> None:
    """A folder of part files, each with header and byte-order mark."""
    csv_writer(df, sep, mark).csv(path)


def write_folders(df: DataFrame, by: str, path: str, name: str, sep: str = SANITIZER_SEPARATOR, mark: bool = True, encoding: str = "UTF-8") -> list[str]:
    """One folder of part files per value of a column, named by `name` with the value in its braces.

    Written as partitions in one job, whose folders are then renamed."""
    spark = df.sparkSession
    fs, root = hadoop_path(spark, path)
    jvm = spark.sparkContext._jvm
    work = jvm.org.apache.hadoop.fs.Path(root, "_work")
    rows = df.withColumn("_folder", F.col(by).cast("string"))
    csv_writer(rows, sep, mark, encoding).partitionBy("_folder").csv(work.toString())
    out = []
    for status in fs.listStatus(work):
        found = str(status.getPath().getName())
        if found.startswith("_folder="):
            value = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(found.split("=", 1)[1])
            to = jvm.org.apache.hadoop.fs.Path(root, name.format(value))
            fs.delete(to, True)
            fs.rename(status.getPath(), to)
            out.append(str(to.toString()))
    fs.delete(work, True)
    return sorted(out)


def write_deliverable(df: DataFrame, path: str, sep: str = AUDIT_SEPARATOR) -> int:
    """One file with byte-order mark for a spreadsheet; rows stream through the driver.  For reports, not for tables that grow."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f, delimiter=sep, lineterminator="\n")
        out.writerow(df.columns)
        for row in df.toLocalIterator():
            out.writerow(row)
            n += 1
    return n


def write_months(df: DataFrame, path: str, month: str = "mes_entrega") -> list[str]:
    """One folder <month>_LIMPIO.csv per month."""
    return write_folders(df, month, path, "{}_LIMPIO.csv")


def write_parts(numbered: DataFrame, path: str) -> None:
    """One folder per part of numbered rows, in order, with the row number first."""
    columns = ["indice", *[c for c in numbered.columns if c not in ("indice", "parte")]]
    by_part = numbered.repartition("parte").sortWithinPartitions("parte", "indice")
    csv_writer(by_part.select("parte", *columns), SANITIZER_SEPARATOR, False).partitionBy("parte").csv(path)


def write_indicators(indicators: DataFrame, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(indicator_text(indicators.first()), encoding="utf-8")


def ranking_sheets(consolidated: DataFrame, n: int = 50) -> dict[str, DataFrame]:
    """The sheets of a ranking workbook: the whole period and each month."""
    months = [(r["mes_orden"], r["mes_nombre"]) for r in monthly_evolution(consolidated).select("mes_orden", "mes_nombre").collect()]
    monthly = rank_products_monthly(consolidated, n)
    sheets = {"Global_Periodo": rank_products(consolidated, n)}
    for order, name in months:
        sheets[name[:SHEET_NAME]] = monthly.where((monthly["mes_orden"] == order) & (monthly["mes_nombre"] == name)).orderBy("ranking")
    return sheets


def write_workbook(sheets: dict[str, DataFrame], path: str) -> bool:
    """An Excel workbook if openpyxl is installed, else one CSV per sheet beside it; whether it was a workbook."""
    try:
        import openpyxl
    except ImportError:
        for name, df in sheets.items():
            write_deliverable(df, f"{path}.{name}.csv", SANITIZER_SEPARATOR)
        return False
    book = openpyxl.Workbook(write_only=True)
    for name, df in sheets.items():
        sheet = book.create_sheet(name)
        sheet.append(df.columns)
        for row in df.toLocalIterator():
            sheet.append(list(row))
    book.save(path)
    return True


def write_chart(df: DataFrame, path: str, label: str, values: Sequence[str], kind: str = "bar") -> bool:
    """A bar, line or pie chart if matplotlib is installed, else the chart's table; whether it was a chart."""
    try:
        from matplotlib import pyplot
    except ImportError:
        write_deliverable(df.select(label, *values), f"{path}.csv", SANITIZER_SEPARATOR)
        return False
    rows = df.select(label, *values).collect()
    figure, axis = pyplot.subplots()
    for i, value in enumerate(values):
        drawn = axis if i == 0 else axis.twinx()
        names, numbers = [r[label] for r in rows], [r[value] for r in rows]
        if kind == "pie":
            drawn.pie(numbers, labels=names, wedgeprops={"width": 0.3}, autopct="%1.1f%%")
        elif kind == "bar" and i == 0:
            drawn.bar(names, numbers)
        else:
            drawn.plot(names, numbers, marker="o")
    figure.savefig(path)
    pyplot.close(figure)
    return True
