"""Reading and writing of tables, alternatives between sources, side outputs, previews and samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from faultline.functions.dates import moment, parse_date
from faultline.session import scratch_folder


def load_fault_log(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    fmt: str = "parquet",
    id_column: str | None = None,
    date_columns: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The event log with a typed id and parsed dates.

    Text formats need a schema: types are never inferred. An id that is no number becomes null.
    """
    if fmt != "parquet" and schema is None:
        raise ValueError("text formats need an explicit schema")
    reader = spark.read.format(fmt).options(**(options or ({"header": "true"} if fmt == "csv" else {})))
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    if id_column is not None:
        df = df.withColumn(id_column, whole_id(F.col(f"`{id_column}`")))
    for c in date_columns:
        if not isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType)):
            df = df.withColumn(c, parse_date(F.col(f"`{c}`")))
    return df


def whole_id(value: Column) -> Column:
    """An id as bigint: whole numbers as they are; floats ("17.0", "1.7e1") only where they are whole and exact.

    Anything else is no id and becomes null.
    """
    text = F.trim(value.cast("string"))
    number = text.try_cast("double")
    exact = (F.abs(number) <= F.lit(float(1 << 53))) & (number == F.floor(number))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint")).when(exact, number.try_cast("bigint"))


def load_assets(spark: SparkSession, path: str, renames: Mapping[str, str], schema: T.StructType | str | None = None,
                fmt: str = "parquet") -> DataFrame:
    """The asset table with source names mapped to ours."""
    return load_fault_log(spark, path, schema, fmt).withColumnsRenamed(dict(renames))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_log_by_month(df: DataFrame, ts: str, path: str) -> None:
    """Persist an event log partitioned by month, so cutoff and horizon filters prune whole folders."""
    write_table(df.withColumn("event_month", F.date_format(ts, "yyyy-MM")), path, ["event_month"])


def read_log_between(spark: SparkSession, path: str, ts: str, start: str, end: str) -> DataFrame:
    """Events in [start, end) of a log written by month: the months prune folders, the bounds reach the files."""
    log = spark.read.parquet(path)
    months = F.col("event_month").cast("string").between(start[:7], end[:7])
    return log.filter(months & (F.col(ts) >= moment(start)) & (F.col(ts) < moment(end))).drop("event_month")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds a table: its schema can be read. A missing or empty folder is none."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def first_available(spark: SparkSession, paths: Sequence[str]) -> tuple[str, DataFrame]:
    """The first of several sources that exists (calibrated, then survival, then raw probabilities)."""
    for p in paths:
        if path_exists(spark, p):
            return p, spark.read.parquet(p)
    raise FileNotFoundError(f"none of {list(paths)} exists")


def write_split(df: DataFrame, rejected: Column, rejected_path: str) -> DataFrame:
    """Write the rejected branch as an audit table and return the kept one; the input is computed once.

    Rows without a verdict are kept. Both branches are written to a shared folder with the verdict as partition.
    """
    folder = scratch_folder(df.sparkSession)
    df.withColumn("_rejected", F.coalesce(rejected, F.lit(False)).cast("int")).write.partitionBy("_rejected").parquet(folder)
    stored = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("_rejected", T.IntegerType())])).parquet(folder)
    write_table(stored.filter("_rejected = 1").drop("_rejected"), rejected_path)
    return stored.filter("_rejected = 0").drop("_rejected")


def preview(df: DataFrame, n: int, order: Sequence[str | Column] = ()) -> DataFrame:
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """n rows in hash order of their keys: the same rows whatever the partitioning."""
    h = F.xxhash64(F.lit(seed), *keys)
    return df.orderBy(h, *keys).limit(n)
