"""Delimited tables with a header, and the query-log tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts that count as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None,
    position: str | None = None, multiline: bool = False,
) -> DataFrame:
    """Delimited text with a header line; every column stays a string unless a schema says so.

    Files are split, whatever their size. `multiline` is needed for quoted line breaks only and
    makes each file one task. `position` adds a column that orders rows as the files, by name, and
    the lines in them do: (path, start of the split, place in the split).
    """
    reader = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
        .option("nullValue", "").option("enforceSchema", False)
    )
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if position:
        df = df.withColumn(position, F.struct(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
            F.monotonically_increasing_id().alias("no")))
    df = df.select([
        F.when(~F.col(f"`{c}`").isin(MISSING), F.col(f"`{c}`")).alias(c) if c in text
        else F.col(f"`{c}`") for c in df.columns
    ])
    return df


def read_query_log(
    spark: SparkSession, objects: str, users: str, texts: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The object, user and text logs (parquet, ideally partitioned by logdate)."""
    return (
        spark.read.parquet(objects).select(
            "ProcID", "QueryID", "logdate", "ObjectDatabaseName", "ObjectTableName",
            "CollectTimeStamp"),
        spark.read.parquet(users).select(
            "ProcID", "QueryID", "logdate", "SessionID", "StatementType", "Username"),
        spark.read.parquet(texts).select("ProcID", "QueryID", "logdate", "SQLTEXTINFO"),
    )
