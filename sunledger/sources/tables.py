"""Readers and writers of forecast tables, landing files and report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.functions.columns import MODELS

BOM = "\ufeff"
WALL_CLOCK = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def oof_schema(models: Sequence[str] = MODELS, suffix: str = "_kWh") -> T.StructType:
    """Schema of the monthly out-of-fold table: month, half, actual and one column per model."""
    numbers = [T.StructField(f"{name}{suffix}", T.DoubleType()) for name in ["actual", *models]]
    return T.StructType([T.StructField("month", T.DateType()), T.StructField("half", T.StringType()), *numbers])


def nan_to_null(df: DataFrame) -> DataFrame:
    """A NaN of another tool means missing; Spark would sort it above every number."""
    fixed = {
        f.name: F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixed) if fixed else df


def read_oof(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, site_pattern: str) -> DataFrame:
    """Read the tables of all sites in one scan; the site comes from the file path.

    ``path`` may be a glob. Header and byte-order mark are handled by the reader, empty cells are NULL.
    """
    raw = spark.read.csv(path, header=True, schema=schema)
    site = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), site_pattern, 1))
    return nan_to_null(raw.select(site.alias("site"), *[F.col(f"`{c}`") for c in schema.fieldNames()]))


def write_oof(df: DataFrame, path: str) -> None:
    """One folder per site, CSV with header and byte-order mark."""
    body = [c for c in df.columns if c != "site"]
    with_bom(df.select("site", *body), first=body[0]).write.partitionBy("site").csv(path, header=True)


def with_bom(df: DataFrame, first: str | None = None) -> DataFrame:
    """Spark has no byte-order-mark option, so the first header carries it."""
    name = first or df.columns[0]
    return df.withColumnRenamed(name, BOM + name)


def write_metrics(df: DataFrame, path: str, order: Sequence[str], single_file: bool = False) -> None:
    """Metric table as CSV with header and byte-order mark, without an index.

    One file per partition; ``single_file=True`` writes one ordered file, for a report of few rows.
    """
    out = with_bom(df)
    names = [BOM + c if c == df.columns[0] else c for c in order]
    out = out.repartition(1).sortWithinPartitions(*names) if single_file else out
    out.write.csv(path, header=True)


def read_landing(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Landing files of one source. Text columns stay text; parsing is a separate, visible step."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("timestampNTZFormat", WALL_CLOCK)
    return nan_to_null(reader.format(fmt).load(path))


def write_landing(df: DataFrame, path: str) -> None:
    """CSV with header; wall-clock times keep their microseconds."""
    df.write.option("timestampNTZFormat", WALL_CLOCK).csv(path, header=True)


def markdown_tables(df: DataFrame, by: Sequence[str], columns: Mapping[str, Column], order: Sequence[str]) -> DataFrame:
    """One copyable Markdown table per group (a site's report), as a string column.

    ``columns`` maps headings to text columns. A group is a report table, so it is short.
    """
    head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns)
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns.values()]), F.lit(" |"))
    rows = df.select(*by, F.struct(*order, line.alias("_line")).alias("_r"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("_r")), lambda r: r["_line"]), "\n")
    return rows.groupBy(*by).agg(F.concat(F.lit(head + "\n"), body).alias("markdown"))
