"""Raw text files: one reading per line, columns by position, order of lines kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vanewatch.spec import RAW_COLUMNS

LINE_ORDER = ("file", "block", "row")


def read_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Non-blank lines with ``file, block, row, tokens``.

    ``row`` is assigned right at the scan, where a block of a file is read front to back by one
    task; (file, block, row) is the line order, ``row`` alone is not.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.split(F.trim("value"), r"\s+").alias("tokens"),
    )
    return lines.where((F.size("tokens") > 1) | (F.get("tokens", F.lit(0)) != ""))


def number(token: Column, kind: str = "double") -> Column:
    """Parsed token, NULL when it is not a number."""
    return token.try_cast(kind)


def telemetry_rows(lines: DataFrame, columns: tuple[str, ...] = RAW_COLUMNS) -> DataFrame:
    """Positional names and types: the first two columns are integers, the others doubles."""
    kinds = ["int", "int"] + ["double"] * (len(columns) - 2)
    keep = [c for c in LINE_ORDER if c in lines.columns]
    return lines.select(
        *keep,
        *[
            number(F.get("tokens", F.lit(i)), kind).alias(name)
            for i, (name, kind) in enumerate(zip(columns, kinds))
        ],
    )


def numbered_lines(lines: DataFrame, out: str = "pos") -> DataFrame:
    """Position of each line, counted from 1 through all files in name order.

    Lines are ranked inside their block, which the scan bounds in size; the ordered sum over all
    blocks sees one row per block.
    """
    in_block = Window.partitionBy("file", "block").orderBy("row")
    earlier = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        lines.groupBy("file", "block")
        .agg(F.count(F.lit(1)).alias("_lines"))
        .select("file", "block", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_start"))
    )
    return (
        lines.withColumn(out, F.row_number().over(in_block).cast("bigint"))
        .join(starts, ["file", "block"])
        .withColumn(out, F.col(out) + F.col("_start"))
        .drop("_start")
    )


def rul_rows(lines: DataFrame) -> DataFrame:
    """True remaining life, one integer per line: ``pos`` (from 1, in line order) and ``RUL``."""
    return numbered_lines(lines).select("pos", number(F.get("tokens", F.lit(0)), "int").alias("RUL"))


def read_rul(spark: SparkSession, path: str) -> DataFrame:
    return rul_rows(read_lines(spark, path))


def land(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy raw lines into the landing folder unless it already has them, and read them there.

    Every line is stored with its file, block and row, so the order of lines outlives the copy however
    the files were packed into tasks.
    """
    read_lines(spark, source).write.mode("ignore").parquet(target)
    return read_landed(spark, target)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed lines with ``file, block, row, tokens``."""
    return spark.read.parquet(path)
