"""Readers: lines of text, delimited tables, key/value files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from batchkit.functions.text import strip


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line of a file or folder, in column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_table(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    infer: bool = False,
    multi_line: bool = False,
    null_value: str = "\0",
) -> DataFrame:
    """Read a delimited file. Nothing between two separators is NULL, ``""`` is an empty text.

    A field equal to ``null_value`` is NULL too; the default is one that files do not hold.

    A declared ``schema`` costs no extra pass over the data; ``infer=True`` reads the
    input twice. Quoted fields may hold the separator, doubled quotes and, with
    ``multi_line``, line breaks (such files cannot be split between tasks).
    """
    reader = spark.read.options(
        sep=sep, header=header, quote='"', escape='"', multiLine=multi_line, nullValue=null_value,
        emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_key_value(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """Read the headerless ``key<TAB>value`` lines that ``write_key_value`` makes.

    A line is cut at its first tab; all other characters, quotes and blanks too, are part of key or
    value. ``schema`` names and types the two columns. What does not parse as its type is NULL, as
    is the value of a line without a tab; an empty text stays an empty text.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    key, value = schema.fields
    parts = F.split(F.col("value"), "\t", 2)
    return spark.read.text(path).select(
        parts[0].try_cast(key.dataType).alias(key.name),
        F.try_element_at(parts, F.lit(2)).try_cast(value.dataType).alias(value.name),
    )


def drop_header(lines: DataFrame, header: str, column: str = "line") -> DataFrame:
    """Remove every line equal to ``header``, ignoring white space around both."""
    return lines.filter(strip(F.col(column)) != strip(F.lit(header)))


def parse_delimited(
    lines: DataFrame,
    schema: StructType | str,
    sep: str = ",",
    column: str = "line",
    timestamp_format: str | None = None,
) -> DataFrame:
    """Parse each line to typed columns; a field that does not parse becomes NULL.

    ``timestamp_format`` is the pattern of all timestamps, with or without time zone.
    """
    options = {"sep": sep, "mode": "PERMISSIVE"}
    if timestamp_format:
        options |= {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format}
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema
    )
    parsed = F.from_csv(F.col(column), ddl, options)
    return lines.select(parsed.alias("_row")).select("_row.*")


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a table for ``spark.sql`` and hand it back."""
    df.createOrReplaceTempView(name)
    return df


def explode_lines(df: DataFrame, column: str) -> DataFrame:
    """One row per line of a text column that holds several lines, in column ``line``."""
    return df.select(F.explode(F.split(F.col(column), "\n")).alias("line"))
