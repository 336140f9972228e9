"""CDC batch files: pipe-delimited CSV with a header, one folder per batch.

A batch folder is named ``batch=<yyyyMMdd-HHmmss>`` (the time the batch was
cut), or batches are flat files whose name starts with that time; full-load
files or folders start with ``LOAD``.  The batch time of every row comes from
its file path (``_metadata.file_path``), so many batches are read by one scan
and ordered by that time instead of one job per file.  Files are listed once,
their header lines are read by one small job (a task stops at a file's first
line), and files with one header are read together.
"""

from __future__ import annotations

import csv
import re
from contextlib import contextmanager
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.coerce import coerce_types, stamp_load_time
from ledgerline.session import materialize, missing

BATCH_PATTERN = r"batch=(\d{8}-\d{6})"
BATCH_FORMAT = "yyyyMMdd-HHmmss"
# Time in a flat file's name, as replication tools write it: 20240131-123456789.csv
FILE_PATTERN = r"(\d{8}-\d{6})\d*[^/]*$"
# NULL is written as \N so that an empty string survives the round trip.
CSV_OPTIONS = {"header": "true", "sep": "|", "quote": '"', "escape": '"', "multiLine": "true",
               "nullValue": "\\N"}

#: Bytes of a file from which on it is worth a look whether it can be split (a split's usual size).
LARGE_FILE = 128 << 20


def batch_glob(path: str) -> str:
    """Only the batch folders of a CDC location (full-load files live beside them)."""
    return f"{path.rstrip('/')}/batch=*"


def file_time(path_col: str = "_metadata.file_path") -> F.Column:
    """Batch time parsed from a CDC file path: of its batch folder, or else
    of the file's own name (NULL when it has none)."""
    path = F.col(path_col)
    stamp = F.coalesce(F.nullif(F.regexp_extract(path, BATCH_PATTERN, 1), F.lit("")),
                       F.nullif(F.regexp_extract(path, FILE_PATTERN, 1), F.lit("")))
    return F.to_timestamp_ntz(stamp, F.lit(BATCH_FORMAT))


def write_cdc_batches(df: DataFrame, path: str, time_col: str = "file_time", mode: str = "overwrite",
                      compression: str = "none") -> None:
    """Write rows as CDC batch files, one folder per batch time.  Every
    column is written as text, as a replication tool would (some pack their
    files: ``compression="gzip"``; a packed file is read by one task)."""
    out = df.withColumn("batch", F.date_format(F.col(time_col), BATCH_FORMAT)).drop(time_col)
    out = out.select(*[F.col(c).cast("string").alias(c) if c != "batch" else F.col(c) for c in out.columns])
    out.write.mode(mode).options(**CSV_OPTIONS, compression=compression).partitionBy("batch").csv(path)


def write_full_load(df: DataFrame, path: str, compression: str = "none") -> None:
    df.select(*[F.col(c).cast("string") for c in df.columns]) \
        .write.mode("overwrite").options(**CSV_OPTIONS, compression=compression).csv(f"{path.rstrip('/')}/LOAD")


def text_schema(columns: list[str]) -> T.StructType:
    """All-string schema: CDC text is typed explicitly after reading (no
    inference pass over the data)."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def list_files(spark: SparkSession, path: str, full: bool = False, since: str | None = None) -> list[str]:
    """Paths of the CDC files at ``path`` (``full``: of the full load), those
    of batches strictly after ``since``.  Files are listed once, as every read
    does, and of older folders only the names; no file is opened."""
    root = path.rstrip("/")
    glob = f"{root}/LOAD*" if full else f"{root}/{_batches(since)}"
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(glob).inputFiles()
    except AnalysisException as e:
        if not missing(e):
            raise
        return []
    if since and not full:
        after = datetime.fromisoformat(since)
        files = [f for f in files if (t := batch_time(f)) is not None and t > after]
    return sorted(unquote(f) for f in files)


def _batches(since: str | None) -> str:
    """Glob of batch folders and flat batch files; with ``since``, of names from that second on."""
    if not since:
        return "{batch=*,[0-9]*}"
    stamps = stamps_from(datetime.fromisoformat(since).strftime("%Y%m%d-%H%M%S"))
    return "{" + ",".join(f"{start}{s}" for s in stamps for start in ("batch=", "")) + "}"


def stamps_from(stamp: str) -> list[str]:
    """Globs of the names that begin with a time not before ``stamp``: the time
    itself, or its first digits and then a larger one."""
    larger = [f"{stamp[:k]}[{int(c) + 1}-9]*" for k, c in enumerate(stamp) if c.isdigit() and c < "9"]
    return [f"{stamp}*", *larger]


def batch_time(path: str) -> datetime | None:
    """:func:`file_time` of one path."""
    found = re.search(BATCH_PATTERN, path) or re.search(FILE_PATTERN, path)
    return datetime.strptime(found[1], "%Y%m%d-%H%M%S") if found else None


def _first_lines(batches):
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def headers(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header line; empty files are left out.

    One task per file takes the file's first line, and drops the rest; a large
    file is split, and its later splits give nothing.  Should files share a
    task, further rounds take those whose line was not seen.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    while files:
        with _one_file_per_task(spark):
            lines = (spark.read.text(files).where(F.col("_metadata.file_block_start") == 0)
                     .select("value", F.col("_metadata.file_path").alias("path")).mapInArrow(_first_lines, "value string, path string").collect())
        for line in lines:
            names = tuple(next(csv.reader([line["value"].lstrip("\ufeff")], delimiter=CSV_OPTIONS["sep"], quotechar=CSV_OPTIONS["quote"])))
            if len(set(names)) < len(names):
                raise ValueError(f"header of {line['path']} names a column twice: {names}")
            groups.setdefault(names, []).append(unquote(line["path"]))
        seen = {_bare(f) for found in groups.values() for f in found}
        left = [f for f in files if _bare(f) not in seen]
        files = left if lines else []
    return {names: sorted(found) for names, found in sorted(groups.items())}


def _bare(path: str) -> str:
    """A path without its scheme's varying number of slashes."""
    return re.sub(r"^(\w+:)/+", r"\1/", path)


@contextmanager
def _one_file_per_task(spark: SparkSession):
    conf = {"spark.sql.files.maxPartitionBytes": str(LARGE_FILE), "spark.sql.files.openCostInBytes": str(1 << 40)}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def read_cdc(spark: SparkSession, path: str, columns: list[str] | None = None, types: dict[str, str] | None = None,
             full: bool = False, since: str | None = None, multiline: bool | str = True,
             repair: tuple[str, ...] = (), optional: tuple[str, ...] = ()) -> DataFrame:
    """Read CDC batches (``full=True``: the full-load files ``LOAD*``) as
    text, take the given columns by name, type them and add ``file_time``.

    Batches are folders ``batch=<time>`` or flat files whose name starts with
    the time.  Files may differ in their header: they are grouped by it, each
    group is read with its own, and columns are aligned by name.  One that a
    file does not have is NULL in its rows; ``optional`` columns are part of the
    result only if some file has them; without ``columns`` all that any file has
    are taken.  ``since`` keeps batches strictly newer than that time: older
    files are listed, not read.  By default a file is one task, unless it is
    larger than ``LARGE_FILE`` and :func:`line_files` finds that each of its
    lines is a record: it is then split; ``multiline=False`` lets Spark split large files (only when no value
    contains a line break), ``multiline="split"`` splits them whatever the
    values hold (see :func:`split_records`).  ``repair`` names payload
    columns of legacy exports (quotes doubled, no escape character) to run
    through :func:`ledgerline.functions.repair_quotes`; correctly escaped files
    need no repair.  Without any file the result is empty.
    """
    return read_files(spark, list_files(spark, path, full, since), columns, types, full, multiline, repair, optional)


def read_files(spark: SparkSession, files: list[str], columns: list[str] | None = None, types: dict[str, str] | None = None,
               full: bool = False, multiline: bool | str = True, repair: tuple[str, ...] = (), optional: tuple[str, ...] = ()) -> DataFrame:
    """:func:`read_cdc` of the given files."""
    groups = headers(spark, files)
    found = list(dict.fromkeys(c for names in groups for c in names))
    columns = [c for c in found if c not in optional] if columns is None else list(columns)
    columns += [c for c in optional if c in found and c not in columns]
    reader = spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false")
    out = spark.createDataFrame([], _empty_schema(columns, full))
    by_line = line_files(spark, files) if multiline is True else set()
    reads = []
    for names, paths in groups.items():
        lined = [f for f in paths if _bare(f) in by_line]
        whole = [f for f in paths if _bare(f) not in by_line]
        reads += [(names, some, how) for some, how in ((whole, multiline), (lined, False)) if some]
    for k, (names, paths, how) in enumerate(reads):
        if how == "split":
            df = split_records(spark, paths, list(names))
            df = df.drop("path") if full else df.withColumn("file_time", file_time("path"))
        else:
            df = reader.option("multiLine", str(how is True).lower()).schema(text_schema(list(names))).csv(paths)
            df = df.select("*") if full else df.withColumn("file_time", file_time())
        by_name = [(F.col(f"`{c}`") if c in names else F.lit(None).cast("string")).alias(c) for c in columns]
        df = df.select(*by_name, *([] if full else ["file_time"]))
        out = out.unionByName(df) if k else df
    return _repair(coerce_types(out, types or {}), repair)


def line_files(spark: SparkSession, files: list[str], larger_than: int | None = None) -> set[str]:
    """The large ones of the files in which each line is a whole record, so
    that splitting them changes nothing.

    A line is whole if, doubled quotes apart, all its quotes are around a
    field, and if it has nothing that a reader of lines takes otherwise than
    one of files: a carriage return, no text, a byte order mark.  One pass over
    the large files, by splits; only names are collected.
    """
    if not files:
        return set()
    larger_than = LARGE_FILE if larger_than is None else larger_than
    large = [r[0] for r in spark.read.format("binaryFile").load(files).where(F.col("length") > larger_than).select("path").collect()]
    if not large:
        return set()
    sep, line = re.escape(CSV_OPTIONS["sep"]), F.col("value")
    fields = F.regexp_replace(F.replace(line, F.lit('""'), F.lit("")), rf'(^|{sep})"[^"]*"(?={sep}|\z)', "")
    other = F.contains(fields, F.lit('"')) | F.contains(line, F.lit("\r")) | (F.trim(line) == "") | F.startswith(line, F.lit("\ufeff"))
    lines = spark.read.option("lineSep", "\n").text(large).select("value", F.col("_metadata.file_path").alias("path"))
    mixed = {_bare(unquote(r[0])) for r in lines.where(other).select("path").distinct().collect()}
    return {_bare(f) for f in large} - mixed


#: Stands for a line break inside a value while a record is parsed (a private character).
_BREAK = "\ue00a"


def split_records(spark: SparkSession, files: list[str], names: list[str]) -> DataFrame:
    """Records of CSV files with one header, as text columns and ``path``, read
    by splits although values may hold line breaks.

    A line break lies inside a value where the quotes before it, from the start
    of the file, are odd in number (an escaped quote is two).  Each split counts
    its quotes; the parity in which a split begins is the sum over the splits
    before it, one narrow row per split.  Within a split a running parity finds
    where records begin.  Lines that are whole records go straight to the
    parser; only those that are parts of one are brought together, across
    splits where a record runs over them.  Quotes must stand only around values
    or doubled inside them, as replication tools write them.
    """
    lines = (spark.read.option("lineSep", "\n").text(files)
             .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
                     F.monotonically_increasing_id().alias("line")))
    lines = lines.withColumn("odd", (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2)
    in_file, in_split = W.partitionBy("path").orderBy("split"), W.partitionBy("path", "split").orderBy("line")
    earlier, before = in_file.rowsBetween(W.unboundedPreceding, -1), in_split.rowsBetween(W.unboundedPreceding, -1)
    opens = lines.groupBy("path", "split").agg((F.sum("odd") % 2).alias("odd"))
    opens = opens.select("path", "split", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("open"))
    placed = lines.join(opens, ["path", "split"])
    placed = placed.withColumn("inside", (F.col("open") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2)
    placed = placed.withColumn("record", F.sum(1 - F.col("inside")).over(in_split.rowsBetween(W.unboundedPreceding, 0)))
    # Written once: the lines are used three times from here on.
    placed = materialize(placed.select("value", "path", "split", "line", "odd", "inside", "record"), "csv-lines")
    # The header is the first record of its file.
    placed = placed.where("not (split = 0 and record = 1)")
    whole = placed.where("inside = 0 and odd = 0").select("path", F.col("value").alias("text"))
    parts = placed.where("inside = 1 or odd = 1")
    # A split's lines before its first record belong to the last record of the nearest split before it that has one.
    last = placed.groupBy("path", "split").agg(F.max("record").alias("last"))
    owner = F.last(F.when(F.col("last") > 0, F.struct("split", F.col("last").alias("record"))), ignorenulls=True).over(earlier)
    parts = parts.join(last.select("path", "split", owner.alias("owner")), ["path", "split"])
    own = F.col("record") > 0
    parts = parts.select("path", F.when(own, F.col("split")).otherwise(F.col("owner.split")).alias("from"), F.when(own, F.col("record")).otherwise(F.col("owner.record")).alias("nth"),
                         F.struct("split", "line", "value").alias("piece"))
    joined = (parts.groupBy("path", "from", "nth").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
              .select("path", F.array_join(F.transform("pieces", lambda p: p["value"]), _BREAK).alias("text")))
    text = F.regexp_replace("text", "\r$", "")
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "multiLine")}
    row = F.from_csv(text, ", ".join(f"`{c}` string" for c in names), options)
    rows = whole.unionByName(joined).where(F.length(text) > 0).select("path", row.alias("row"))
    return rows.select("path", *[F.replace(F.col(f"row.`{c}`"), F.lit(_BREAK), F.lit("\n")).alias(c) for c in names])


def _empty_schema(columns: list[str], full: bool) -> T.StructType:
    extra = [] if full else [T.StructField("file_time", T.TimestampNTZType())]
    return T.StructType([*text_schema(columns).fields, *extra])


# --- types of the columns ------------------------------------------------------

#: Narrowest first.  A value fits a set of these; a column's values fit the intersection.
LATTICE = ("int", "bigint", "decimal(38,0)", "double", "date", "timestamp_ntz", "boolean")
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$"
_FORMS = {"int": _WHOLE, "bigint": _WHOLE, "decimal(38,0)": _WHOLE, "double": _NUMBER, "date": _DATE, "timestamp_ntz": _TIME, "boolean": r"(?i)^(true|false)$"}


def _bits(*types: str) -> int:
    return sum(1 << LATTICE.index(t) for t in types)


def fitting(col: F.Column) -> F.Column:
    """Bit mask of the types that the text fits (NULL for NULL and empty text, which fit all).

    The forms are told apart first: a value has one of them (a whole number is
    also a number, a date also a time), and only the casts of that form are
    tried.  Most text is told from all of them by its first character.
    """
    def has(form: str) -> F.Column:
        return col.rlike(_FORMS[form])

    def cast(types: tuple[str, ...]) -> F.Column:
        return reduce(F.Column.bitwiseOR, (F.when(col.try_cast(t).isNotNull(), _bits(t)).otherwise(0) for t in types))

    first = F.substring(col, 1, 1)
    # A whole number that is an int is also all that follows.
    whole = F.when(col.try_cast("int").isNotNull(), _bits("int", "bigint", "decimal(38,0)", "double")).otherwise(cast(("bigint", "decimal(38,0)", "double")))
    mask = (F.when(first.isin(*"tTfF"), F.when(has("boolean"), cast(("boolean",))).otherwise(0))
            .when(~first.isin(*"+-.0123456789"), 0)
            .when(has("int"), whole).when(has("double"), cast(("double",)))
            .when(has("date"), cast(("date", "timestamp_ntz"))).when(has("timestamp_ntz"), cast(("timestamp_ntz",))).otherwise(0))
    return F.when(F.length(col) > 0, mask)


def column_types(columns: list[str]) -> list[F.Column]:
    """One aggregate per column: the masks' intersection.  Tasks reduce their rows, Spark meets the results."""
    return [F.bit_and(fitting(F.col(f"`{c}`"))).alias(c) for c in columns]


def narrowest(mask: int | None) -> str:
    """The first type of the intersection; text where there is none or no value."""
    return next((t for k, t in enumerate(LATTICE) if mask is not None and mask >> k & 1), "string")


def infer_cdc(spark: SparkSession, path: str, columns: list[str] | None = None, full: bool = False, since: str | None = None,
              multiline: bool = True, forced: dict[str, str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """CDC rows with inferred column types, and the types.

    The files are parsed once: their text is written to the shared folder while
    the types are observed on the rows that pass, and the typed rows are cast
    from that copy.  ``forced`` types override the inferred ones.
    """
    text = read_cdc(spark, path, columns, None, full, since, multiline)
    names = [c for c in text.columns if c != "file_time"]
    seen = Observation("cdc-types")
    copy = materialize(text.observe(seen, F.count(F.lit(1)).alias("__rows"), *column_types(names)), "cdc-text")
    masks = seen.get
    types = {c: narrowest(masks.get(c)) for c in names} | {k: v for k, v in (forced or {}).items() if k in names}
    return coerce_types(copy, {c: t for c, t in types.items() if t != "string"}), types


def _repair(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    from ledgerline.functions.text import repair_quotes
    return df.withColumns({c: repair_quotes(c) for c in columns}) if columns else df


def pending_batches(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Distinct batch times after ``since``, in time order (for progress
    reporting; the pipelines consume batches as one DataFrame).  Only paths
    are listed; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = files.load(f"{path.rstrip('/')}/{_batches(since)}").select("path")
    except AnalysisException as e:
        if not missing(e):
            raise
        return spark.createDataFrame([], "file_time timestamp_ntz")
    t = files.select(file_time("path").alias("file_time")).where("file_time is not null").distinct()
    if since:
        t = t.where(F.col("file_time") > F.lit(since).cast("timestamp_ntz"))
    return t.orderBy("file_time")


def initial_load(spark: SparkSession, path: str, columns: list[str], types: dict[str, str],
                 run_ts: str | None = None) -> DataFrame:
    """Full-load files -> typed rows stamped with the load time."""
    return stamp_load_time(read_cdc(spark, path, columns, types, full=True), run_ts)
