"""Readers and writers: CSV in and out (separator, decimal comma, BOM),
header-less instrument worklists, many run logs tagged from their paths,
and experiment tables saved per run for later continuation.

Writers target the folder the caller gives (on a cluster: shared storage);
``vialflow.session.scratch_path`` gives a unique one under the cluster's
checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BOM = "﻿"


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",", decimal: str = ".",
             header: bool = True) -> DataFrame:
    """Read CSV with a declared schema. Columns are read as text and cast, so
    a decimal comma (``decimal=','``) is translated first; a UTF-8 BOM on the
    first field is stripped; unparsable numbers become NULL."""
    text = StructType([StructField(f.name, StringType(), True) for f in schema.fields])
    raw = (spark.read.option("header", header).option("sep", sep).option("encoding", "UTF-8")
           .schema(text).csv(path))
    first = schema.fields[0].name
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.name == first:
            c = F.regexp_replace(c, f"^{BOM}", "")
        if f.dataType.typeName() in ("double", "float", "decimal"):
            if decimal != ".":
                c = F.translate(c, decimal, ".")
            c = F.trim(c).try_cast(f.dataType)
        elif f.dataType.typeName() != "string":
            c = F.trim(c).try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def write_csv(df: DataFrame, path: str, sep: str = ",", decimal: str = ".", header: bool = True) -> None:
    """Write CSV (no index column exists in a DataFrame); with a decimal comma
    the double columns are written as text with ',' as separator."""
    out = df
    if decimal != ".":
        out = df.select(*[F.translate(F.col(f.name).cast("string"), ".", decimal).alias(f.name)
                          if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                          for f in df.schema.fields])
    out.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def write_worklist(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Instrument file: header-less CSV with a fixed column order."""
    df.select(*columns).write.mode("overwrite").option("header", False).csv(path)


def read_run_logs(spark: SparkSession, pattern: str, schema: StructType, run_regex: str) -> DataFrame:
    """Read every CSV log matching ``pattern`` (same shape) and tag rows with
    the run id captured by ``run_regex`` from the file path."""
    df = spark.read.option("header", True).schema(schema).csv(pattern)
    return df.withColumn("run", F.regexp_extract(F.col("_metadata.file_path"), run_regex, 1))


def save_space(df: DataFrame, path: str, run_id: str) -> None:
    """Save an experiment table under ``run_id=<id>`` (parquet); other runs in
    the same folder are kept."""
    (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))


def load_space(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Reload one run's table (partition pruning reads only that run)."""
    return spark.read.parquet(path).where(F.col("run_id") == run_id).drop("run_id")
