"""CSV and parquet files of raw and staged listings."""

from __future__ import annotations

import csv
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmill.operators.clean import with_missing_as_null
from lotmill.schemas import CLEAN_COLUMNS, CLEAN_TYPES, RAW_COLUMNS, RAW_SCHEMA, typed_columns
from lotmill.session import no_rows

# Quotes are doubled inside quoted cells, and cells may hold line breaks.
CSV = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


def _csv_options(multi_line: bool) -> dict[str, str]:
    return {**CSV, "multiLine": str(multi_line).lower(), "enforceSchema": "false"}


# A file can be read if its header names this column.
NEEDED = "Page_Link"


def file_headers(lines: DataFrame) -> DataFrame:
    """(file_path, header) of every file with a line; ``lines`` are text lines with the hidden ``_metadata``.

    Runs as one aggregation with a row per file and task; only first lines are shuffled.
    """
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return (
        lines.select("value", F.col("_metadata.file_path").alias("file_path"), place.alias("_place"))
        .groupBy("file_path")
        .agg(F.min_by("value", "_place").alias("header"))
    )


def header_columns(header: str) -> list[str] | None:
    """Column names of a header line as the raw tables spell them; None if it is no header of listings."""
    try:
        names = next(csv.reader([header.lstrip("\ufeff")]), [])
    except csv.Error:
        return None
    spelled = {c.lower(): c for c in RAW_COLUMNS}
    found = [spelled.get(n.strip().lower(), n.strip()) for n in names]
    known = [c for c in found if c in spelled.values()]
    return found if NEEDED in known and len(known) == len(set(known)) else None


# Column of the raw text of a record whose cells are not those of its file's header.
BROKEN = "_broken"


def _read_group(spark: SparkSession, columns: list[str], paths: list[str], multi_line: bool) -> DataFrame:
    """Files with one header: columns by name, absent ones null, others left out; ``raw_line`` as in :func:`read_files`."""
    own = [c if c in RAW_COLUMNS else f"_other{i}" for i, c in enumerate(columns)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*own, BROKEN]])
    # Without column pruning every record is cut into all its cells, whatever columns are asked for; only so are they counted.
    options = {
        **CSV, "multiLine": str(multi_line).lower(), "enforceSchema": "true",
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN, "columnPruning": "false",
        # A quote left open then runs on to the next closing one, and the cells it swallows are missed in the count.
        "unescapedQuoteHandling": "STOP_AT_CLOSING_QUOTE",
    }
    rows = spark.read.schema(schema).options(**options).csv(paths)
    cell = lambda c: F.when(F.col(BROKEN).isNull(), F.col(c)) if c in own else F.lit(None).cast("string")
    # Spark reads no file for the record's text alone, so that is tied to a cell by nothing of its text.
    record = F.concat(F.rtrim(F.col(BROKEN), F.lit("\r\n")), F.left(F.coalesce(F.col(own[0]), F.lit("")), F.lit(0)))
    return rows.select(
        *[cell(c).alias(c) for c in RAW_COLUMNS],
        raw_name(F.col("_metadata.file_path")).alias("file_name"),
        record.alias("raw_line"),
    )


def raw_name(path: Column) -> Column:
    """The path of a file as it was given; Spark reports it percent-encoded, and so are the values of partition folders."""
    decoded = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    twice = F.try_url_decode(F.replace(decoded, F.lit("+"), F.lit("%2B")))
    once = F.coalesce(decoded, path)
    return F.when(path.contains("/file_name="), F.coalesce(twice, once)).otherwise(once)


def read_files(spark: SparkSession, headers: list, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Raw rows of files, and the files that cannot be read, from (file_path, header) rows.

    Files are grouped by header and each group is read with its own order of columns, so a
    moved, missing or additional column does no harm. A file whose header is none of a listing file goes to
    the second table (file_path, header) and leaves the others alone. A record with more or fewer cells than
    its file's header, as an unquoted comma or an open quote makes it, has null cells and its text in ``raw_line``, which is null
    for all others.
    """
    groups: dict[tuple, list[str]] = {}
    bad = []
    for row in headers:
        columns = header_columns(row["header"] or "")
        if columns is None:
            bad.append((row["file_path"], row["header"]))
        else:
            groups.setdefault(tuple(columns), []).append(_plain(row["file_path"]))
    rows = None
    for columns, paths in sorted(groups.items()):
        group = _read_group(spark, list(columns), paths, multi_line)
        rows = group if rows is None else rows.unionByName(group)
    if rows is None:
        rows = empty_raw(spark).withColumns({c: F.lit(None).cast("string") for c in ("file_name", "raw_line")})
    named = T.StructType([T.StructField(c, T.StringType()) for c in ("file_path", "header")])
    return with_missing_as_null(rows), spark.createDataFrame(bad, named) if bad else no_rows(spark, named)


def _plain(uri: str) -> str:
    """A path for Spark's readers, which take glob patterns, from an encoded one."""
    scheme, _, rest = uri.partition(":")
    return scheme + ":" + re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(rest))


def _lines(reader):
    return reader.option("recursiveFileLookup", "true").schema("value string")


def read_raw(spark: SparkSession, folder: str, multi_line: bool = True) -> DataFrame:
    """All raw CSV files under a folder, as text, with ``file_name``.

    Missing-value tokens become null; empty and header-only files add no
    rows. ``file_name`` is the file's path, from which the region is read. Files with
    other headers than those of listings add no rows, nor do records with other cells than their header; :func:`read_files` reports both. A
    file whose cells hold line breaks cannot be split; for single-line
    data ``multi_line=False`` lets large files be read by many tasks.
    """
    headers = file_headers(_lines(spark.read).text(folder)).collect()
    return read_files(spark, headers, multi_line)[0].filter("raw_line IS NULL").drop("raw_line")


def stream_headers(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    """The lines of new files as a stream, each file once; :func:`file_headers` is for its batches."""
    reader = _lines(spark.readStream)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder).select("value", "_metadata")


def write_raw(df: DataFrame, folder: str, mode: str = "append") -> None:
    """Raw rows as CSV, one sub-folder per raw file name."""
    df.select(*RAW_COLUMNS, "file_name").write.mode(mode).options(**CSV).partitionBy(
        "file_name"
    ).csv(folder)


def empty_raw(spark: SparkSession) -> DataFrame:
    """No rows, raw columns."""
    return no_rows(spark, RAW_SCHEMA)


def write_header_only(spark: SparkSession, folder: str) -> None:
    """A CSV file with the raw header and no rows."""
    empty_raw(spark).coalesce(1).write.mode("overwrite").options(**CSV).csv(folder)


def write_staging(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Overwrite the staging data; nothing is written when no row survived."""
    clean = df.select(*CLEAN_COLUMNS)
    if clean.isEmpty():
        return False
    options = CSV if fmt == "csv" else {}
    clean.write.mode("overwrite").options(**options).format(fmt).save(path)
    return True


def read_staging_csv(spark: SparkSession, folder: str, multi_line: bool = True) -> DataFrame:
    """Typed clean listings from the ``staging*.csv`` files of a folder.

    Null and empty text are the same in a CSV file; text columns read back
    as empty, so only unreadable dates and numbers are null. Without line breaks in
    cells, ``multi_line=False`` lets many tasks read one file.
    """
    text_schema = T.StructType([T.StructField(c, T.StringType()) for c in CLEAN_COLUMNS])
    rows = (
        spark.read.schema(text_schema)
        .options(**_csv_options(multi_line), recursiveFileLookup="true")
        .csv(f"{folder}/staging*.csv")
    )
    filled = rows.select("*", F.col("_metadata.file_path").alias("file_name")).na.fill("")
    return filled.select(*typed_columns(CLEAN_TYPES), "file_name")


def copy_into(spark: SparkSession, path: str, table: str, multi_line: bool = True, not_null: bool = False) -> None:
    """Bulk copy of a clean CSV into a table, columns matched by name.

    A value that is not of its column's type is an error, with ``not_null`` also a missing one, as Spark holds a parquet table's
    text to its length but not its columns to NOT NULL. The copy itself meets the error, and then nothing is copied. Text
    that is empty in the file is empty in the table.
    """
    text_schema = T.StructType([T.StructField(c, T.StringType()) for c in CLEAN_COLUMNS])
    rows = spark.read.schema(text_schema).options(**_csv_options(multi_line)).csv(path).na.fill("")
    where = F.concat(F.lit(" of row "), F.col(CLEAN_COLUMNS[0]))
    checked = {}
    for c, value in zip(CLEAN_COLUMNS, typed_columns(CLEAN_TYPES)):
        wrong = F.when(F.col(c) != "", F.raise_error(F.concat(F.lit(c), where, F.lit(" does not fit its column"))))
        absent = F.raise_error(F.concat(F.lit(f"{c} is missing"), where)) if not_null else F.lit(None)
        checked[c] = F.when(value.isNotNull(), value).otherwise(wrong.otherwise(absent))
    columns = spark.table(table).columns
    absent = {c: F.lit(None) for c in columns if c not in checked}
    rows.select(*[{**checked, **absent}[c].alias(c) for c in columns]).write.insertInto(table)
