"""Comparison of two column-lineage mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querytrail.functions.text import trim_blank
from querytrail.schemas import DIFFERENCES, MAPPING_ALIASES
from querytrail.session import store

KEY_COLUMNS = [
    "target_db", "target_table", "target_column", "source_db", "source_table", "source_column",
]
# Codes and texts of the difference report.
ONLY_FIRST = ("12", "Present in File 1 but not in File 2")
ONLY_SECOND = ("21", "Present in File 2 but not in File 1")
#: How many rows of one position can be told apart.
TIES = 10 ** 10
REPORT_ORDER = ["error_code", "target_db", "target_table", "target_column"]


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def resolve_aliases(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Standard names for the six mapping columns; an error when one has no known spelling."""
    found = {}
    for standard, spellings in MAPPING_ALIASES.items():
        hits = [s for s in spellings if s in df.columns]
        if not hits:
            raise ValueError(f"no column for {standard}; available columns: {df.columns}")
        found[standard] = hits[0]
    return df.select(*keep, *[F.col(found[c]).alias(c) for c in KEY_COLUMNS])


def comparison_key() -> Column:
    """Trimmed, lower-cased text of the six columns; null counts as the text nan."""
    parts = [trim_blank(F.coalesce(F.col(c).cast("string"), F.lit("nan"))) for c in KEY_COLUMNS]
    return F.lower(F.concat_ws("|", *parts))


def _keyed(df: DataFrame, order: list[str]) -> DataFrame:
    if not order:
        raise ValueError("name the columns that give the row order")
    renamed = normalize_headers(df)
    keep = [c.strip().lower().replace(" ", "_") for c in order]
    first = F.struct(*keep).alias("_order")
    return resolve_aliases(renamed.select("*", first), ("_order",)).withColumn(
        "comparison_key", comparison_key())


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each key in the given row order (null keys are equal).

    `min_by` combines rows before the shuffle, so a key with very many copies sends one row per
    task.
    """
    rest = [c for c in df.columns if c not in keys]
    if rest == order and len(order) == 1:  # nothing else to carry, so a hash aggregate will do
        return df.groupBy(*keys).agg(F.min(order[0]).alias(order[0])).select(*df.columns)
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def _key_hash() -> Column:
    return F.xxhash64("comparison_key")


def _first_rows(rows: DataFrame, one_sided: bool) -> DataFrame:
    """The first row of each key, of all keys or of those that one side alone has: (six columns,
    comparison_key, _side).

    Only hashes of keys, sides and positions go through the aggregate, all of fixed width, so it is a
    hash aggregate and copies of a key are combined before the shuffle. The rows wanted are then
    fetched by hash and position. A second hash tells when keys share the first one; their rows, rarely any,
    are compared by the keys themselves. The same is done for wanted rows whose order is not one whole number.
    """
    order = rows.schema["_order"].dataType
    numbered = len(order) == 1 and isinstance(order[0].dataType, T.IntegralType)
    # Rows of one position are told apart by their content; which one comes first is then fixed, too.
    tie = F.pmod(F.xxhash64(*KEY_COLUMNS), F.lit(TIES)).cast("decimal(10,0)")
    at = (F.col("_order")[order[0].name].cast("decimal(19,0)") * F.lit(TIES).cast("decimal(11,0)") + tie).cast(
        "decimal(38,0)") if numbered else F.lit(0).cast("decimal(38,0)")
    hashed = rows.withColumns({"_hash": _key_hash(), "_at": at})
    grouped = hashed.withColumn("_other", F.xxhash64(F.lit(1), "comparison_key")).groupBy(
        F.col("_hash").alias("_h")).agg(
        F.min("_side").alias("_low"), F.max("_side").alias("_high"), F.min("_at").alias("_first"),
        F.min("_other").alias("_other_low"), F.max("_other").alias("_other_high"))
    clash, alone = F.col("_other_low") != F.col("_other_high"), F.col("_low") == F.col("_high")
    found = store(grouped.filter(alone | clash if one_sided else F.lit(True)).select(
        "_h", "_first", clash.alias("_clash")), "key-hashes")
    names = [*KEY_COLUMNS, "comparison_key", "_side"]

    def by_key(some: DataFrame) -> DataFrame:
        best = some.groupBy("comparison_key").agg(
            F.min("_side").alias("_low"), F.max("_side").alias("_high"),
            F.min_by(F.struct(*KEY_COLUMNS, "_side"), F.struct("_side", "_order")).alias("_row"))
        return best.filter(alone if one_sided else F.lit(True)).select("_row.*", "comparison_key").select(*names)

    same = F.col("_hash") == F.col("_h")
    clear = found.filter("not _clash")
    if numbered:
        first = hashed.join(clear, same & (F.col("_at") == F.col("_first")), "left_semi").select(*names).distinct()
    else:
        first = by_key(hashed.join(clear, same, "left_semi"))
    clashing = found.filter("_clash")
    if clashing.isEmpty():
        return first
    return first.unionByName(by_key(hashed.join(clashing, same, "left_semi")))


def unique_mapping(df: DataFrame, order: list[str]) -> DataFrame:
    """One row per comparison key, the first one kept."""
    rows = _keyed(df, order).withColumn("_side", F.lit(1))
    return _first_rows(rows, one_sided=False).select(*KEY_COLUMNS, "comparison_key")


def compare_mappings(
    first: DataFrame, second: DataFrame, order: list[str]
) -> DataFrame:
    """Rows only in one mapping: code 12 = only in the first, 21 = only in the second.

    One hash aggregate over (hash of the key, side, position) finds the one-sided keys and the position of
    their first rows; only those rows are then fetched.
    """
    one = _keyed(first, order).withColumn("_side", F.lit(1))
    two = _keyed(second, order).withColumn("_side", F.lit(2))
    rows = _first_rows(one.unionByName(two), one_sided=True)
    code, text = [
        F.when(F.col("_side") == 1, a).otherwise(b) for a, b in zip(ONLY_FIRST, ONLY_SECOND, strict=True)
    ]
    return rows.withColumns({"error_code": code, "description": text}).select(*DIFFERENCES.names)


def ordered_report(differences: DataFrame) -> DataFrame:
    return differences.orderBy(*[F.col(c).asc_nulls_last() for c in REPORT_ORDER])


def difference_counts(differences: DataFrame) -> DataFrame:
    """Differences by code and target database."""
    return differences.groupBy("error_code", "target_db").agg(F.count("*").alias("differences"))


def sample_report(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first n rows, each with the number of rows that are not shown."""
    total = df.agg(F.greatest(F.count("*") - n, F.lit(0)).alias("more_rows"))
    top = df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
    # `total` is one row and `top` at most n, both by construction.
    return top.withColumn("_one", F.lit(1)).join(
        total.withColumn("_one", F.lit(1)), "_one").drop("_one")
