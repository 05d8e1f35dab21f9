"""Reading and writing meter readings and their summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally import schema as S
from gridtally.functions.calendar import month_of
from gridtally.operators.filters import time_range

# Files whose headers the driver looks at together.
HEADER_THREADS = 16


def normalize_columns(df: DataFrame, names: dict[str, str] = S.HEADER_NAMES) -> DataFrame:
    """Give known headers their column names; the first of several aliases wins."""
    taken = set(df.columns)
    renames = {}
    for header, name in names.items():
        if header in df.columns and name not in taken:
            renames[header] = name
            taken.add(name)
    return df.withColumnsRenamed(renames)


def resolve_column(df: DataFrame, patterns: Sequence[str]) -> str | None:
    """First column whose name contains a keyword; earlier keywords are tried first."""
    return next((c for p in patterns for c in df.columns if p in c), None)


def coerce_valid(df: DataFrame, ts: str = S.TS, value: str | None = None) -> DataFrame:
    """Turn text into times and numbers and drop the rows where that is impossible."""
    fixed = {ts: F.try_to_timestamp(F.col(ts).cast("string")).cast("timestamp_ntz")}
    if value:
        fixed[value] = F.col(value).try_cast("double")
    return df.withColumns(fixed).dropna(subset=list(fixed))


def _conform(df: DataFrame) -> DataFrame:
    """Cast the known columns of a frame that was read as text."""
    known = {f.name: f.dataType for f in S.READINGS_SCHEMA.fields}
    return df.withColumns(
        {
            c: F.to_timestamp(c).cast("timestamp_ntz") if c == S.TS else F.col(c).cast(known[c])
            for c in df.columns
            if c in known
        }
    )


def _files_by_header(spark: SparkSession, path: str, encoding: str) -> dict[str, list[str]]:
    """The files below `path` by their first line; files without one hold no rows and are left out.

    Only first lines are read, many files at a time, from any file system and codec that Spark reads.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(name: str) -> str | None:
        file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = file.getFileSystem(conf).open(file)
        try:
            codec = codecs.getCodec(file)
            text = codec.createInputStream(stream) if codec else stream
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, encoding)).readLine()
        finally:
            stream.close()

    files = spark.read.text(path).inputFiles()
    with ThreadPool(HEADER_THREADS) as pool:
        lines = pool.map(first_line, files)
    groups: dict[str, list[str]] = {}
    for file, line in sorted(zip(files, lines)):
        if line is not None:
            groups.setdefault(line.removeprefix("\ufeff").strip(), []).append(file)
    return groups


def _read_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """CSV with headers, as text, under the known column names.

    Files may have their columns in another order, under other known names, or lack some: files with
    equal first lines are read together and united by name, and a column that a file lacks is null.
    """
    groups = _files_by_header(spark, path, options.get("encoding", "UTF-8"))
    if len(groups) < 2:
        return normalize_columns(spark.read.csv(path, header=True, enforceSchema=False, **options))
    # a folder's name=value parts stay columns
    base = {} if any(c in path for c in "*?[{") else {"basePath": path}
    reader = spark.read.options(header=True, enforceSchema=False, inferSchema=False, **base, **options)
    tables = [normalize_columns(reader.csv([unquote(f) for f in files])) for files in groups.values()]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), tables)


def read_readings(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Readings from CSV, or from parquet as `write_predictions` lays it out.

    `start` (included) and `end` (excluded) also skip the month folders of a parquet table.
    """
    if fmt == "csv":
        # Text first: names decide the types.
        df = _conform(_read_csv(spark, path))
    elif fmt == "parquet":
        df = normalize_columns(spark.read.parquet(path))
    else:
        raise ValueError(f"fmt must be csv or parquet, not {fmt!r}")
    if S.TS not in df.columns:
        raise ValueError(f"no reading time among the columns {df.columns} of {path}")
    bounds = [None if b is None else F.lit(b).cast("timestamp_ntz") for b in (start, end)]
    return time_range(df, *bounds)


def read_csv_encoded(spark: SparkSession, path: str, encoding: str = "CP949") -> DataFrame:
    """CSV in a Korean code page; needs spark.sql.legacy.javaCharsets=true (see build_session)."""
    return _read_csv(spark, path, encoding=encoding)


def read_monthly_summary(spark: SparkSession, path: str) -> DataFrame:
    """Monthly totals; the month text becomes the first day of that month."""
    df = _read_csv(spark, path)
    return df.withColumns(
        {
            c: F.to_date(c, "yyyy-MM") if c == S.MONTH else F.col(c).cast("double")
            for c in df.columns
        }
    )


def write_submission(df: DataFrame, path: str, prediction: str | Column = "prediction") -> None:
    value = F.col(prediction) if isinstance(prediction, str) else prediction
    df.select(F.col(S.READING_ID).alias("id"), value.alias("prediction")).write.csv(path, header=True)


def write_predictions(df: DataFrame, path: str, targets: Sequence[str] = S.MEASURES) -> None:
    """Id, time, work type and every predicted measure, one folder per month.

    Tasks take ranges of time, so that a month with most of the rows is written by many of them,
    a task touches few folders, and row groups hold narrow time ranges.
    """
    cols = [c for c in (S.READING_ID, S.METER, S.TS, S.WORK_TYPE) if c in df.columns]
    (
        df.select(*cols, *targets, month_of(S.TS).alias(S.MONTH))
        .repartitionByRange(S.TS, S.READING_ID)
        .write.partitionBy(S.MONTH)
        .parquet(path)
    )


def read_to_forecast(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Rows that wait for a forecast: id, time and work type, without measures."""
    df = read_readings(spark, path, fmt)
    return df.select(*[c for c in S.TO_FORECAST_SCHEMA.fieldNames() if c in df.columns])
