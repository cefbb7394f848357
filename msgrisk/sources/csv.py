"""CSV scan: per-file encoding choice, padded short rows, dropped over-long rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CORRUPT = "_corrupt_row"
# The two encodings a file can be read with: UTF-8 if all its bytes are valid, else Latin-1.
VALID, FALLBACK = "UTF-8", "ISO-8859-1"


# A quoted cell that opens at a cell's start and closes on the same line; and a cell that opens, whatever follows.
CLOSED_CELL = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'
OPEN_CELL = r'(^|,)"'


class Layout(NamedTuple):
    """How a group of files is read. multi_line: records may span lines, so that a file cannot be split."""

    encoding: str
    heading: str
    multi_line: bool


def _spans_lines(line: Column) -> Column:
    """Whether a line (without its end) may be read otherwise as a part of its file than on its own.

    True if a quoted cell does not close on it, if a lone carriage return stands in it, or if it is blank but not empty.
    Where no line of a file is so, each record is one line: the first begins outside of quotes, and so does each next.
    """
    quoted = line.contains('"') & F.regexp_replace(line, CLOSED_CELL, "$1").rlike(OPEN_CELL)
    return quoted | line.contains("\r") | ((F.length(line) > 0) & (F.length(F.trim(line)) == 0))


def files_by_layout(spark: SparkSession, path: str | list[str]) -> dict[Layout, list[str]]:
    """Files grouped by the encoding that can read them, their heading line, and whether records span lines.

    One scan, split by bytes, with a map-side combined aggregate of one row per file. Only file names and heading
    lines reach the driver, which holds the listing of a file scan in any case.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    # The end of a line and the mark at the start of a file are no part of a cell.
    ended = F.when(F.endswith("value", F.lit("\r")), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    lines = raw.select(
        F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("valid"),
        F.ltrim(ended, F.lit("\ufeff")).alias("line"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
    )
    heading = F.substring_index(F.min_by("line", "at"), "\r", 1)
    checked = lines.groupBy("file").agg(
        F.min("valid").alias("valid"), heading.alias("heading"), F.max(_spans_lines(F.col("line"))).alias("spans"),
    )
    groups: dict[Layout, list[str]] = {}
    for row in checked.orderBy("file").toLocalIterator():
        groups.setdefault(Layout(VALID if row.valid else FALLBACK, row.heading, row.spans), []).append(row.file)
    return groups


def _reader(spark: SparkSession, encoding: str, multi_line: bool):
    return spark.read.options(
        header=True, encoding=encoding, multiLine=multi_line, quote='"', escape='"', mode="PERMISSIVE"
    )


def _read_group(spark: SparkSession, files: list[str], encoding: str, multi_line: bool) -> DataFrame:
    reader = _reader(spark, encoding, multi_line)
    columns = reader.csv(files[0]).columns
    fields = [T.StructField(name, T.StringType()) for name in columns]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    rows = reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).csv(files)
    # The reader flags short and long rows alike; a row is long if it has too many separators
    # outside quoted cells; a quote opens a cell only at its start. Rows with the right number of
    # fields never reach the pattern.
    bare = F.regexp_replace(CORRUPT, r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|\s*$)', "$1")
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    over_long = F.col(CORRUPT).isNotNull() & (separators >= len(columns))
    return rows.filter(~over_long).drop(CORRUPT)


def read_csv(
    spark: SparkSession, path: str | list[str], multi_line: bool | None = None, encoding: str | None = None
) -> DataFrame:
    """All columns as strings; rows with too many fields are left out, short rows end in nulls.

    Files with different headings are united by column name. The pass that looks for encodings and headings also
    finds the files with newlines inside quotes: each of these is one task, all others are split by bytes.
    multi_line says for all files whether to read them whole, and is not needed for right results.

    Given an encoding, that pass is saved: all files must have the heading of the first, and they are read whole
    unless multi_line is False.
    """
    if encoding:
        return _read_group(spark, [path] if isinstance(path, str) else path, encoding, multi_line is not False)
    groups = files_by_layout(spark, path)
    if not groups:
        raise RuntimeError(f"No CSV file with a heading below {path}")
    frames = [
        _read_group(spark, files, layout.encoding, layout.multi_line if multi_line is None else multi_line)
        for layout, files in groups.items()
    ]
    result, *rest = frames
    for frame in rest:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
