"""File and table sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.functions.urls import norm_url
from gazetta.functions.values import VERIFY_REQUIRED, strip


def read_csv_strings(
    spark: SparkSession, path: str, multi_line: bool = False, sep: str = ",", **options: str
) -> DataFrame:
    """CSV with every column as text; lines with surplus fields are dropped.

    Empty fields, and those a short line lacks, are ``''``.  ``multi_line`` allows
    line feeds in quoted fields; a file is then read by one task.  Without it the
    lines are looked through first, and only the files in which a quoted field is open at the end of a
    line are read that way; a stray quote inside a field, such as an inch sign, costs nothing.
    """
    whole = None if multi_line else files_with_open_quotes(spark, path, sep)
    reader = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("sep", sep)
        # which lines have too many fields must not depend on the columns that are asked for
        .option("columnPruning", False)
        .options(**options)
    )
    names = reader.option("multiLine", whole != []).csv(path).columns
    odd = "_odd_line"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, odd]])
    # the reader marks lines with too few fields, too: count the separators outside quotes
    bare = F.regexp_replace(F.col(odd), r'"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    # the reader refuses to give the marked lines alone, so a value is always read along
    read_along = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0

    def rows(by_file: bool, only: Column | None = None) -> DataFrame:
        lenient = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", odd)
        df = lenient.option("multiLine", by_file).schema(schema).csv(path)
        if only is not None:
            df = df.filter(only)
        kept = df.filter(F.col(odd).isNull() | ((fields <= len(names)) & read_along))
        return kept.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names])

    if not whole:
        return rows(whole is None)
    # a filter on the file's name leaves the other files out of the scan
    is_whole = F.col("_metadata.file_path").isin(whole)
    return rows(False, ~is_whole).unionByName(rows(True, is_whole))


def files_with_open_quotes(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """The files in which some line ends inside a quoted field, by the name Spark gives them.

    Doubled quotes stand for one inside a field and are left out; a quote opens a field only at its start.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    single = F.replace(F.col("value"), F.lit('""'), F.lit(""))
    is_open = (quotes % 2 == 1) & single.rlike(f'(?:^|\\Q{sep}\\E)"[^"]*$')
    return sorted(r["file"] for r in lines.where(is_open).select("file").distinct().collect())


def conform(df: DataFrame, columns: Sequence[str], default: str = VERIFY_REQUIRED) -> DataFrame:
    """Exactly the given columns in order: missing ones take the default, others are dropped."""
    return df.select(
        *[F.col(f"`{c}`") if c in df.columns else F.lit(default).alias(c) for c in columns]
    )


def header_or_default(header: Sequence[str], default: Sequence[str]) -> list[str]:
    """Column list of a starter file if it has the expected width, else the default list."""
    named = [c.strip() for c in header if c.strip()]
    return named if len(named) == len(default) else list(default)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold one JSON array each."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def with_seed(df: DataFrame, seed: DataFrame, required: Sequence[str]) -> DataFrame:
    """Add seed rows in which every required column is filled."""
    good = seed
    for c in required:
        good = good.filter(F.length(strip(c)) > 0)
    return df.unionByName(good, allowMissingColumns=True)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_json_arrays(df: DataFrame, path: str, rows: int = 50_000) -> None:
    """Files of one JSON array each, as many as leave them about ``rows`` rows, whatever the size of the table."""
    number = -(-df.count() // rows) or 1
    # by a random number: repeated rows do not meet in one file
    dealt = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.floor(F.rand(42) * number).alias("file"))
    arrays = dealt.groupBy("file").agg(F.to_json(F.collect_list("row")).alias("value"))
    arrays.write.partitionBy("file").text(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append-only JSON lines; values without a JSON form are written as text."""
    plain = (T.BinaryType, T.DayTimeIntervalType, T.YearMonthIntervalType)
    cols = [
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, plain) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*cols).write.mode("append").option("ignoreNullFields", False).json(path)


def clean_keys(lines: DataFrame, column: str = "value") -> DataFrame:
    """Key list: no blank or '#' lines, normalised, distinct, sorted."""
    text = strip(column)
    return (
        lines.filter((text != "") & ~text.startswith("#"))
        .select(norm_url(column).alias("url_key"))
        .filter(F.col("url_key") != "")
        .distinct()
        .orderBy("url_key")
    )


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    return clean_keys(spark.read.text(path))


def write_keys(df: DataFrame, column: str, path: str) -> None:
    clean_keys(df, column).withColumnRenamed("url_key", "value").write.text(path)


def scan(
    spark: SparkSession, path: str, columns: Sequence[str], predicate: Column | str | None = None
) -> DataFrame:
    """Projected and filtered table scan; both reach the Parquet reader."""
    df = spark.read.parquet(path)
    if predicate is not None:
        df = df.filter(predicate)
    return df.select(*columns)


def scan_jdbc(
    spark: SparkSession, url: str, table: str, columns: Sequence[str], on: str, low: int, high: int, parts: int
) -> DataFrame:
    """The same from a database, read in parallel ranges of a numeric column."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=on,
            lowerBound=str(low),
            upperBound=str(high),
            numPartitions=str(parts),
        )
        .load()
        .select(*columns)
    )


def write_csv(df: DataFrame, columns: Sequence[str], path: str, mode: str = "append") -> None:
    """CSV with a fixed header; other fields are ignored."""
    df.select(*columns).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_outcomes(df: DataFrame, outcome: str, path: str) -> None:
    """Outcome log, one folder per tag, appended."""
    df.write.mode("append").partitionBy(outcome).json(path)
