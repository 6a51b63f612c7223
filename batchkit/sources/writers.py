"""Writers: text lines, key/value files and CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _files(df: DataFrame, single_file: bool, order: list[Column] | None) -> DataFrame:
    """One file per partition, or a single one, whose rows are sorted in its one task.

    Not coalesce: only the final write runs in one task, the work before it keeps its parallelism.
    """
    if not single_file:
        return df.orderBy(*order) if order else df
    return df.repartition(1).sortWithinPartitions(*order) if order else df.repartition(1)


def write_lines(
    df: DataFrame,
    path: str,
    single_file: bool = False,
    mode: str = "error",
    order: list[Column] | None = None,
) -> None:
    """Write a one-column string table as text, one line per row.

    With ``order`` the lines of a single file, or of all files by name, are in that order. Without
    it a single file has them in any order, whatever ``df`` was sorted by.
    """
    _files(df, single_file, order).write.mode(mode).text(path)


def write_key_value(
    df: DataFrame,
    path: str,
    single_file: bool = False,
    mode: str = "error",
    order: list[Column] | None = None,
) -> None:
    """Write the columns separated by tabs, without header or quoting, nothing changed or trimmed.

    NULL is written as an empty field. A text column but the last must hold no tab and none a line
    break, as nothing marks them.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    lines = _files(df, single_file, order).select(F.concat_ws("\t", *fields).alias("line"))
    lines.write.mode(mode).text(path)


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = False,
    single_file: bool = False,
    mode: str = "error",
    order: list[Column] | None = None,
    sep: str = ",",
) -> None:
    """Write CSV, with or without a header line per file, or with another separator (``sep="\\t"``).

    Blanks around values stay, timestamps keep their microseconds, an empty text is written as
    ``""`` and NULL as nothing, so that ``read_table`` tells them apart.
    """
    options = {
        "header": header, "sep": sep, "escape": '"', "emptyValue": '""', "nullValue": "",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    _files(df, single_file, order).write.mode(mode).options(**options).csv(path)


def to_csv_line(df: DataFrame, columns: list[str], sep: str = ",") -> DataFrame:
    """Join the columns to one ``line`` column; NULL is written as an empty field."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(F.concat_ws(sep, *fields).alias("line"))
