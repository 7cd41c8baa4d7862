"""Pipe-delimited text tables: fixed schema, no header, every line ends in ``|``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starmart.schemas import TRAILING_FIELD, raw_schema, with_trailing_field


# No field of a text table reads like this.
_NO_TEXT = "\x00"


def tbl_path(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{table}.tbl"


def read_tbl(
    spark: SparkSession,
    path: str,
    schema: StructType,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read a text table by position and drop the trailing empty field.

    In PERMISSIVE mode a value that does not parse, or a short line, gives NULL in
    the fields concerned and the row is kept. ``corrupt_column`` adds a column with
    the whole line of such rows.
    """
    schema = with_trailing_field(schema)
    reader = spark.read.option("sep", "|").option("mode", mode)
    # An empty field is NULL, a quoted empty one is an empty text.
    reader = reader.option("nullValue", _NO_TEXT)
    if corrupt_column:
        schema = schema.add(corrupt_column, StringType(), True)
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if corrupt_column or mode != "PERMISSIVE":
        # Reading only some columns of a line, Spark would not notice that it is short.
        reader = reader.option("columnPruning", "false")
    return reader.schema(schema).csv(path).drop(TRAILING_FIELD)


def read_raw(
    spark: SparkSession,
    folder: str,
    table: str,
    lineitem_layout: str = "stock",
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read one of the eight raw tables under its fixed schema.

    The contract wants a line id, which stock line items do not have: their first
    field, the order key, stands in for it.
    """
    schema = raw_schema(table, lineitem_layout)
    df = read_tbl(spark, tbl_path(folder, table), schema, mode, corrupt_column)
    if table == "lineitem" and "l_id" not in df.columns:
        df = df.withColumn("l_id", F.col("l_orderkey"))
    return df


def write_tbl(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write a table in the raw text form, trailing separator included.

    ``read_tbl`` gives the same rows back: blanks, quotes, separators, backslashes and
    microseconds are kept, and empty texts (in quotes) are told from NULLs. A line is a
    row, so a text with a line break is an error. ``compression`` is a codec of Spark's
    text files; they are read back by their names.
    """
    micros = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    (
        df.select([_one_line(field) for field in df.schema])
        .withColumn(TRAILING_FIELD, F.lit(None).cast("double"))
        .write.mode("overwrite")
        .option("sep", "|")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("timestampFormat", micros)
        .option("timestampNTZFormat", micros)
        .option("compression", compression)
        .csv(path)
    )


def _one_line(field: StructField) -> Column:
    value = F.col(field.name)
    if not isinstance(field.dataType, StringType):
        return value
    broken = F.raise_error(F.lit(f"{field.name} has a line break or a NUL character"))
    return F.when(value.rlike("[\\n\\r\\x00]"), broken).otherwise(value).alias(field.name)


def land_raw(
    spark: SparkSession, source: str, raw_folder: str, table: str, compression: str = "none"
) -> str:
    """Copy a text table line by line, unparsed, so that parsing can be replayed.

    A line ends at a line feed and at nothing else: carriage returns, alone or before a
    line feed, are kept as they are. A file holds what a task reads, so compressed files,
    which no two tasks can share, stay of a size.
    """
    target = tbl_path(raw_folder, table)
    lines = spark.read.option("lineSep", "\n").text(source)
    writer = lines.write.mode("overwrite").option("lineSep", "\n")
    writer.option("compression", compression).text(target)
    return target


# The column that tells good lines (NULL) from rejected ones (the line).
REJECT_COLUMN = "rejected_line"
REJECTED_FLAG = "is_rejected"


def split_raw(
    spark: SparkSession,
    folder: str,
    table: str,
    staging: str,
    lineitem_layout: str = "stock",
) -> tuple[DataFrame, DataFrame]:
    """All rows of a raw table, and its rejected lines with what could be read of them.

    The text is parsed once, into Parquet that is dealt to two folders by whether the
    line parsed whole. Reading the rejected lines opens only theirs.
    """
    path = f"{staging}/{table}"
    parsed = read_raw(spark, folder, table, lineitem_layout, corrupt_column=REJECT_COLUMN)
    flagged = parsed.withColumn(REJECTED_FLAG, F.col(REJECT_COLUMN).isNotNull())
    flagged.write.mode("overwrite").partitionBy(REJECTED_FLAG).parquet(path)
    stored = spark.read.schema(flagged.schema).parquet(path)
    rejected = stored.where(REJECTED_FLAG).drop(REJECTED_FLAG)
    return stored.drop(REJECTED_FLAG, REJECT_COLUMN), rejected
