"""Delimited text files with a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.operators.columns import accepted, check_types, malformed

LATIN_1 = "ISO-8859-1"
_LINE = "_malformed_line"
FILE_ROWS = 2_000_000
# Texts that stand for a missing value in delimited files.
MISSING_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                  "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _reader(spark: SparkSession, encoding: str, separator: str):
    return (spark.read.option("header", True).option("encoding", encoding).option("sep", separator)
            .option("quote", '"').option("escape", '"'))


def _known(name: str) -> Column:
    """A text column, null where its text stands for a missing value."""
    value = F.col(f"`{name}`")
    return F.when(~value.isin(MISSING_TOKENS), value).alias(name)


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str, encoding: str = "UTF-8",
    separator: str = ",",
) -> DataFrame:
    """Scan with a given schema, whose names must be those of the header.

    No inference pass; files split across tasks; a quoted field may hold the separator. A
    missing file raises. Missing values are those of the text read; a field that is no value of its type
    is null (see ``read_checked`` for what became of it).
    """
    return accepted(read_checked(spark, path, schema, encoding, separator))


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType | str, encoding: str = "UTF-8", separator: str = ",",
) -> DataFrame:
    """As ``read_delimited``, with ``_rejected``: the fields that are no value of their type, and lines with a wrong number of fields.

    Both come from one scan; store it to take ``accepted`` rows and ``rejected`` fields from it.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted] + [T.StructField(_LINE, T.StringType())])
    lines = (_reader(spark, encoding, separator).option("enforceSchema", False).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", _LINE).schema(text).csv(path))
    kinds = {f.name: f.dataType.simpleString() for f in wanted}
    return check_types(lines.select(*[_known(c) for c in kinds], _LINE), kinds, malformed(F.col(_LINE)))


def read_delimited_text(
    spark: SparkSession, path: str, encoding: str = "UTF-8", separator: str = ","
) -> DataFrame:
    """Scan with the header's names and every column as text; types follow by name.

    Texts that stand for a missing value are null, so none becomes a NaN when types follow.
    """
    rows = _reader(spark, encoding, separator).option("inferSchema", False).csv(path)
    return rows.select(*[_known(c) for c in rows.columns])


def write_delimited(
    frame: DataFrame, path: str, encoding: str = "UTF-8", mode: str = "errorifexists", compression: str = "none",
) -> None:
    """One file per partition, each with the header; no row numbers.

    With a ``compression`` that readers know by the files' names, partitions are cut into files of at most
    ``FILE_ROWS`` rows, as such a file is read by one task.
    """
    writer = frame.write.mode(mode) if compression == "none" else frame.write.mode(mode).option("maxRecordsPerFile", FILE_ROWS)
    (writer.option("header", True).option("encoding", encoding).option("compression", compression)
     .option("quote", '"').option("escape", '"').csv(path))
