"""Reading and writing the order-item table as CSV with its raw headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profitlens.functions.arithmetic import null_if_not_finite
from profitlens.functions.dates import parsed_moment
from profitlens.schema import OUR_NAMES, RAW_COLUMNS, TYPES, squash

# Date spellings accepted in the raw export.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "M/d/yyyy H:mm", "yyyy-MM-dd")


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename known columns to our names, whatever their case, blanks or underscores."""
    return df.withColumnsRenamed({c: OUR_NAMES[squash(c)] for c in df.columns if squash(c) in OUR_NAMES})


def known_columns(columns: list[str]) -> list[str]:
    """Header names we know how to use; the others are not read."""
    return [c for c in columns if squash(c) in OUR_NAMES]


def cast_tolerant(df: DataFrame) -> DataFrame:
    """Cast every known column to its type; a text that does not fit becomes null."""
    text = dict(df.dtypes)
    casts = {}
    for name in df.columns:
        wanted = TYPES.get(name)
        if wanted is None or (text[name] == wanted and wanted != "double"):
            continue
        value = F.col(name)
        if wanted == "timestamp_ntz":
            value = parsed_moment(value.cast("string"), DATE_FORMATS)
        else:
            value = value.try_cast(wanted)
        casts[name] = null_if_not_finite(value) if wanted == "double" else value
    return df.withColumns(casts)


def decoded(value: Column) -> Column:
    """Text that was read byte by byte: UTF-8 where it is valid UTF-8, else Latin-1, which it is already."""
    utf8 = F.encode(value, "ISO-8859-1").cast("string")
    return F.when(F.is_valid_utf8(utf8), utf8).otherwise(value)


def read_transactions_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Known columns of a CSV export, with our names and types.

    Only the header is looked at when the plan is built; unknown columns are
    pruned in the CSV scan. Without an encoding every value is read as it is
    and decided on its own, in the same pass: UTF-8, or else Latin-1.
    """
    reader = (
        spark.read.option("header", True)
        .option("encoding", encoding or "ISO-8859-1")
        .option("quote", '"')
        .option("escape", '"')
    )
    raw = reader.csv(path)
    named = normalise_columns(raw.select(*[f"`{c}`" for c in known_columns(raw.columns)]))
    texts = [c for c in named.columns if TYPES[c] == "string"]
    return cast_tolerant(named if encoding else named.withColumns({c: decoded(F.col(c)) for c in texts}))


def write_transactions_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Write with the raw header names, the counterpart of ``read_transactions_csv``."""
    raw_names = {ours: raw for raw, (ours, _) in RAW_COLUMNS.items()}
    columns = [
        (F.date_format(c, DATE_FORMATS[0]) if TYPES[c] == "timestamp_ntz" else F.col(c)).alias(raw_names[c])
        for c in df.columns
    ]
    (
        df.select(*columns)
        .write.mode("overwrite")
        .option("header", True)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
