"""Reading of delivery, target, catalog, cost and consolidated files.

A file may be a folder of part files.  However many files there are, two Spark
jobs look at all of them: one over every line (is it UTF-8, does a quoted field
contain a line break), one for the first lines of each.  Files of one layout are
then read together.  Headers and samples reach the driver, rows never do.
Missing fields of short rows are empty, rows longer than the header are left
out, and all columns are strings."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import hadoop_path, materialize

#: Every byte sequence is valid in latin-1, so nothing comes after it.
ENCODINGS = {"utf-8": "UTF-8", "latin-1": "ISO-8859-1"}
SEPARATORS = (";", ",", "\t", "|")
SAMPLE_LINES = 100
# Beginnings of names that are results of earlier runs, and patterns of event files.
RESULT_PREFIXES = ("no_encontrados", "top_missing", "reporte", "REPORTE", "Consolidado", "Targets")
EVENT_PATTERNS = ("*Evento*.csv", "*evento*.csv", "*EVENTO*.csv", "*abril*.csv", "*mayo*.csv", "*202*.csv")
NAME_NEEDLES = ("descripcion", "nombre", "producto", "medicamento")
CODE_NEEDLES = ("codigo", "cod_neg", "cum", "cums", "ap")
QUANTITY_NEEDLES = ("cantidad_entregada", "cant", "entregad", "unidades")
NAMES_IN_ORDER = ("nombre", "nombres", "descripcion", "producto")
QUANTITIES_IN_ORDER = ("cantidad", "cantidades", "unidades", "cant")


class UnreadableFile(ValueError):
    pass


@dataclass(frozen=True)
class Source:
    """A file as it was found: its path as given and as Spark names it, its first lines, and how to read it."""

    path: str
    key: str
    folder: bool
    lines: tuple[bytes, ...]
    encoding: str
    breaks: bool  # a quoted field spans lines, so that the file can't be read in splits


def look_at(spark: SparkSession, paths: Sequence[str]) -> list[Source]:
    """The sources of these paths, in this order; two jobs for all of them."""
    if not paths:
        return []
    keys, folders = [], []
    for path in paths:
        fs, where = hadoop_path(spark, path)
        keys.append(re.sub("^file:/+", "file:/", str(fs.makeQualified(where).toUri().toString())))
        folders.append(bool(fs.getFileStatus(where).isDirectory()))
    lines = spark.read.text(list(paths)).select(
        "value", _part_file().alias("part"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    lines = lines.withColumn("key", _owner(keys, folders))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    facts = {r["key"]: r for r in lines.groupBy("key").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_or(quotes % 2 == 1).alias("breaks")).collect()}
    order = Window.partitionBy("key").orderBy("part", "row")
    first = lines.where("block = 0").withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_LINES)
    sample: dict[str, list] = {}
    for r in first.select("key", "n", F.col("value").cast("binary").alias("value")).collect():
        sample.setdefault(r["key"], []).append((r["n"], bytes(r["value"])))
    out = []
    for path, key, folder in zip(paths, keys, folders, strict=True):
        found = facts.get(key)
        encoding = "utf-8" if found is None or found["utf8"] else "latin-1"
        out.append(Source(path, key, folder, tuple(v for _, v in sorted(sample.get(key, []))), encoding, bool(found and found["breaks"])))
    return out


def _part_file():
    """The file a row is read from, as Spark names it (local ones with one slash)."""
    return F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")


def _owner(keys: Sequence[str], folders: Sequence[bool]):
    """The source that a part file belongs to: itself or its folder."""
    part = F.col("part")
    if not any(folders):
        return part
    folder = F.regexp_replace(part, "/[^/]*$", "")
    if all(folders):
        return folder
    return F.when(folder.isin([k for k, f in zip(keys, folders, strict=True) if f]), folder).otherwise(part)


def file_encoding(spark: SparkSession, path: str) -> str:
    """utf-8 if every line of the file is, else latin-1; the lines are checked where they are read."""
    return look_at(spark, [path])[0].encoding


def detect_encoding(lines: Sequence[bytes]) -> str:
    try:
        b"\n".join(lines).decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        return "latin-1"


def _header(lines: Sequence[bytes], encoding: str, sep: str) -> list[str]:
    return next(csv.reader(io.StringIO("\n".join(x.decode(encoding, "replace") for x in lines)), delimiter=sep), [])


def widest_separator(lines: Sequence[bytes], encoding: str) -> str:
    """The separator that gives the most columns, the first of equal ones."""
    if not any(x.strip() for x in lines):
        raise UnreadableFile("no header")
    return max(SEPARATORS, key=lambda s: len(_header(lines, encoding, s)))


def comma_or_semicolon(lines: Sequence[bytes], encoding: str) -> str:
    """A comma if it gives two columns or more."""
    return "," if len(_header(lines, encoding, ",")) >= 2 else ";"


def sniff_separator(lines: Sequence[bytes], encoding: str = "") -> str:
    """The separator as the csv module guesses it from the first 4,096 characters; a comma if it can't."""
    text = "\n".join(x.decode(detect_encoding(lines), "replace") for x in lines)[:4096]
    try:
        return csv.Sniffer().sniff(text, delimiters=";,|\t").delimiter if text.strip() else ","
    except csv.Error:
        return ","


def _clean_names(names: Sequence[str]) -> list[str]:
    """Header names without blanks, quotes or byte-order mark; repeated ones get a number."""
    seen: dict[str, int] = {}
    out = []
    for i, name in enumerate(names):
        name = name.replace("\ufeff", "").replace('"', "").strip() or f"columna_{i}"
        k = seen[name] = seen.get(name, -1) + 1
        out.append(f"{name}.{k}" if k else name)
    return out


#: Where a row stands: part file, beginning of its split, and an id that grows within the split.
PLACE = ["_part", "_block", "_row"]


def read_alike(spark: SparkSession, sources: Sequence[Source], sep: str, names: Sequence[str]) -> DataFrame:
    """Sources of one layout as one scan: their columns as strings, and PLACE."""
    places = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*places, "over", "bad"]])
    rows = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("sep", sep).option("encoding", ENCODINGS[sources[0].encoding]).option("quote", '"').option("escape", '"')
        .option("nullValue", "\x00").option("emptyValue", "").option("columnNameOfCorruptRecord", "bad").option("mode", "PERMISSIVE").option("multiLine", any(s.breaks for s in sources))
        .csv([s.path for s in sources])
    )
    kept = rows.where(F.col("over").isNull())
    return kept.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in zip(places, names, strict=True)],
        _part_file().alias("_part"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"),
    )


Separator = Callable[[Sequence[bytes], str], str]


def _layout(source: Source, separator: Separator) -> tuple[str, tuple[str, ...]]:
    sep = separator(source.lines, source.encoding)
    return sep, tuple(_clean_names(_header(source.lines, source.encoding, sep)))


def _one(spark: SparkSession, path: str, separator: Separator) -> tuple[DataFrame, str]:
    """A file with PLACE, and its separator."""
    source = look_at(spark, [path])[0]
    sep, names = _layout(source, separator)
    return read_alike(spark, [source], sep, names), sep


def read_strings(spark: SparkSession, path: str, sep: str) -> DataFrame:
    return _one(spark, path, lambda lines, encoding: sep)[0].drop(*PLACE)


def read_robust(spark: SparkSession, path: str) -> DataFrame:
    """A file of unknown encoding and separator."""
    return _one(spark, path, widest_separator)[0].drop(*PLACE)


def read_sniffed(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """A price file and its separator."""
    rows, sep = _one(spark, path, sniff_separator)
    return rows.drop(*PLACE), sep


def with_ordinal(rows: DataFrame, name: str = "ordinal") -> DataFrame:
    """Rows with PLACE numbered from 0 in file order (part files by name), without gaps.

    Splits are counted and their counts added up; a row's number is its place in
    its split plus the rows before, so rows are neither moved nor sent through Python."""
    splits = rows.groupBy("_part", "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("_part", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_part", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    # one row per split of a file
    numbered = rows.join(F.broadcast(offsets), ["_part", "_block"])
    return numbered.select(*[c for c in rows.columns if c not in PLACE], (F.col("_row") + F.col("_shift")).alias(name))


def by_column(columns: Sequence[str], needles: Sequence[str]) -> str | None:
    """The first column that contains any of the needles."""
    return next((c for c in columns if any(n in c.lower() for n in needles)), None)


def by_needle(columns: Sequence[str], needles: Sequence[str]) -> str | None:
    """The column of the first needle that any column contains."""
    return next((c for n in needles for c in columns if n in c.lower()), None)


def detect_event_columns(columns: Sequence[str]) -> dict[str, str | None]:
    """Name, code and quantity columns of audit files; exact names win."""
    lower = {c.lower(): c for c in columns}
    return {
        "descripcion": lower.get("descripcion") or by_column(columns, NAME_NEEDLES),
        "codigo": lower.get("codigo_neg") or by_column(columns, CODE_NEEDLES),
        "cantidad": by_column(columns, QUANTITY_NEEDLES),
    }


def detect_delivery_columns(columns: Sequence[str]) -> dict[str, str]:
    """Name and quantity columns of sanitizer files, as far as they are found."""
    found = {"descripcion_original": by_needle(columns, NAMES_IN_ORDER), "cantidad": by_needle(columns, QUANTITIES_IN_ORDER)}
    return {k: v for k, v in found.items() if v}


def detect_pair(columns: Sequence[str]) -> dict[str, str] | None:
    """As detect_delivery_columns, None unless both are found."""
    found = detect_delivery_columns(columns)
    return found if len(found) == 2 else None


def list_files(spark: SparkSession, pattern: str, exclude: Sequence[str] = RESULT_PREFIXES) -> list[str]:
    """Sorted paths that match a pattern, without results of earlier runs."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []
    paths = {str(s.getPath().toString()) for s in found}
    return sorted(p for p in paths if not p.rsplit("/", 1)[-1].startswith(tuple(exclude)))


def discover_events(spark: SparkSession, folder: str, patterns: Sequence[str] = EVENT_PATTERNS) -> list[str]:
    return sorted({p for pattern in patterns for p in list_files(spark, f"{folder.rstrip('/')}/{pattern}")})


def month_of(path: str) -> str:
    """A file's name without folder and ending."""
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0]


def _load(spark: SparkSession, paths: Sequence[str], pick: Callable[[Sequence[str]], dict[str, str | None] | str]) -> tuple[list[tuple[DataFrame, dict]], dict[str, str]]:
    """(rows of the files of one layout with PLACE, their month (mes) and their number (_file); the columns picked) and why files were skipped."""
    groups: dict[tuple, list[tuple[int, Source]]] = {}
    skipped: dict[str, str] = {}
    for i, source in enumerate(look_at(spark, paths)):
        try:
            sep, names = _layout(source, widest_separator)
        except (UnreadableFile, csv.Error) as e:
            skipped[source.path] = str(e)
            continue
        picked = pick(names)
        if isinstance(picked, str):
            skipped[source.path] = picked
            continue
        groups.setdefault((sep, names, source.encoding, source.breaks, source.folder), []).append((i, source))
    out = []
    for (sep, names, _, _, folder), members in groups.items():
        rows = read_alike(spark, [s for _, s in members], sep, names)
        # one row per file
        files = spark.createDataFrame([(s.key, month_of(s.path), i) for i, s in members], "_key string, _mes string, _file long")
        owner = F.regexp_replace("_part", "/[^/]*$", "") if folder else F.col("_part")
        out.append((rows.join(F.broadcast(files), owner == F.col("_key")).drop("_key"), pick(names)))
    return out, skipped


def _pick_delivery(names: Sequence[str]) -> dict[str, str | None] | str:
    found = detect_pair(names)
    return found if found and found["descripcion_original"] != found["cantidad"] else "no name or quantity column"


def load_deliveries(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame | None, dict[str, str]]:
    """All sanitizer files with canonical names and mes_entrega, and why others were skipped."""
    groups, skipped = _load(spark, paths, _pick_delivery)
    out = None
    for rows, picked in groups:
        taken = {v.lower() for v in picked.values() if v}
        named = rows.drop(*PLACE, "_file", *[k for k in picked if k not in taken]).withColumnsRenamed({v: k for k, v in picked.items()})
        named = named.drop("mes_entrega").withColumnRenamed("_mes", "mes_entrega")
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out, skipped


def _pick_event(names: Sequence[str]) -> dict[str, str | None] | str:
    found = detect_event_columns(names)
    return found if found["cantidad"] else "no quantity column"


def load_events(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame | None, dict[str, str]]:
    """All audit files as descripcion, codigo, cantidad (text), mes and orden (which grows by file and row); a file without quantity is skipped."""
    groups, skipped = _load(spark, paths, _pick_event)
    out = None
    for rows, picked in groups:
        columns = [(F.col(f"`{c}`") if c else F.lit("")).alias(k) for k, c in picked.items()]
        frame = rows.select(*columns, F.col("_mes").alias("mes"), F.struct("_file", *PLACE).alias("orden"))
        out = frame if out is None else out.unionByName(frame)
    return out, skipped


def load_targets(spark: SparkSession, path: str, source: str = "PRIMARY") -> DataFrame:
    """A contract list as ordinal, fuente, descripcion, codigo."""
    df = _one(spark, path, widest_separator)[0]
    names = [c for c in df.columns if c not in PLACE]
    found = detect_event_columns(names)
    name, code = found["descripcion"] or names[0], found["codigo"]
    return with_ordinal(df.select(F.col(f"`{name}`").alias("descripcion"), (F.col(f"`{code}`") if code else F.lit("")).alias("codigo"), F.lit(source).alias("fuente"), *PLACE))


def load_catalog(spark: SparkSession, path: str, name: str = "producto_genhospi") -> DataFrame:
    """A catalog as ordinal and its name column (the first one if it has no such column)."""
    df = with_ordinal(_one(spark, path, comma_or_semicolon)[0])
    return df.withColumnRenamed(name if name in df.columns else df.columns[0], name)


def positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Named columns where present, else the columns at these places renamed; missing ones are empty."""
    columns = [c for c in df.columns if c not in PLACE]
    lower = {c.lower(): c for c in columns}
    out, used = df, {lower[n] for n in names if n in lower}
    for i, n in enumerate(names):
        if n in lower:
            out = out.withColumnRenamed(lower[n], n)
        elif i < len(columns) and columns[i] not in used:
            out = out.withColumnRenamed(columns[i], n)
        else:
            out = out.withColumn(n, F.lit(""))
    return out


def load_costs(spark: SparkSession, path: str) -> DataFrame:
    return with_ordinal(positional(_one(spark, path, sniff_separator)[0], ("descripcion", "costo")))


def load_price_targets(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    rows, sep = _one(spark, path, sniff_separator)
    return with_ordinal(positional(rows, ("descripcion",))), sep


def load_consolidated(spark: SparkSession, path: str) -> DataFrame:
    """A consolidated table from CSV or, better, Parquet."""
    df = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else read_strings(spark, path, ",")
    return df.withColumns({"total_unidades": F.col("total_unidades").try_cast("double"), "numero_de_entregas": F.col("numero_de_entregas").try_cast("long")})


def number_file(spark: SparkSession, path: str, size: int = 15_000) -> DataFrame:
    """A comma-separated file's rows numbered in its own order (indice, from 0) and in parts of `size` rows (parte, from 1)."""
    rows = with_ordinal(_one(spark, path, lambda lines, encoding: ",")[0], "indice")
    return rows.withColumn("parte", (F.floor(F.col("indice") / size) + 1).cast("long"))


def chunk_numbers(df: DataFrame, order: Sequence[str], size: int = 15_000) -> DataFrame:
    """Rows numbered in an order (indice, from 0) and in parts of `size` rows (parte, from 1).

    Rows are dealt to ranges of the order, sorted and written to the shared
    folder with their place in their range, so that ranges are sampled once and
    whatever reads the result later sees the same ones.  A row's number is its
    place plus the rows of the ranges before; no task sees all rows.  Rows that
    are equal in the order are ranged and numbered by a hash of all their
    columns: only whole copies of one row must share a range."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = [*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    ranged = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # a row's number in its partition
    written = materialize(ranged.select("*", F.spark_partition_id().alias("_range"), place.alias("_place")), "ranged")
    counts = written.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    index = F.col("_place") + F.col("_before")
    out = written.join(F.broadcast(offsets), "_range")  # one row per range
    return out.select(*df.columns, index.alias("indice"), (F.floor(index / size) + 1).cast("long").alias("parte"))
