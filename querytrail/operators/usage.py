"""Classification of tables by the statements that touched them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.functions.text import contains_ci, is_blank
from querytrail.session import store

ACTIVE = "Active Table"
ISOLATED = "Isolated Drop/Rename"
TEMPORARY = "Temporary"

# Texts that mark statements, in any case.
CREATE = "Create "
CHANGE = "Drop|Rename"


def is_create() -> Column:
    return contains_ci(F.col("SQLTEXTINFO"), CREATE)


def is_change() -> Column:
    return contains_ci(F.col("SQLTEXTINFO"), CHANGE)


def latest_rows(usage: DataFrame) -> DataFrame:
    """Rows of each table's latest log date.

    An aggregate joined back, not a window: a table with very many rows stays spread out. The
    aggregate is stored first: joined directly, both sides would keep its partitioning by table
    and Spark could not split a hot one.
    """
    latest = store(
        usage.groupBy("ObjectTableName").agg(F.max("logdate").alias("logdate")), "latest-dates")
    return usage.join(latest, ["ObjectTableName", "logdate"]).select(*usage.columns)


def latest_statements(usage: DataFrame, statement: str, user: str) -> DataFrame:
    """Latest-day rows of one statement type and user."""
    wanted = (F.col("StatementType") == statement) & (F.col("Username") == user)
    columns = [
        "Username", "ObjectDatabaseName", "StatementType", "logdate_Grouped", "StatementType_Count",
    ]
    return latest_rows(usage).filter(wanted).select(
        *[c for c in columns if c in usage.columns])


def table_facts(usage: DataFrame) -> DataFrame:
    """What the latest day of each table shows, in three steps of shrinking aggregates.

    "A later drop for some earlier create" needs no pairs: inside one process it holds when the
    smallest create id is below the largest change id, across sessions likewise.
    """
    create, change = F.col("c"), F.col("d")
    flagged = usage.filter("ObjectTableName is not null").select(
        "ObjectTableName", "logdate", "ProcID", "QueryID", "SessionID",
        is_blank(F.col("SQLTEXTINFO")).alias("blank"), is_create().alias("c"), is_change().alias("d"))
    per_process = flagged.groupBy("ObjectTableName", "logdate", "ProcID").agg(
        F.bool_and("blank").alias("blank"), F.bool_or(create).alias("c"), F.bool_or(change).alias("d"),
        F.min(F.when(create, F.col("QueryID"))).alias("q_create"),
        F.max(F.when(change, F.col("QueryID"))).alias("q_change"),
        F.min(F.when(create, F.col("SessionID"))).alias("s_create"),
        F.max(F.when(change, F.col("SessionID"))).alias("s_change"),
    )
    same_process = F.col("ProcID").isNotNull() & (F.col("q_change") > F.col("q_create"))
    per_day = per_process.groupBy("ObjectTableName", "logdate").agg(
        F.bool_and("blank").alias("blank"), F.bool_or("c").alias("c"), F.bool_or("d").alias("d"),
        F.bool_or(F.coalesce(same_process, F.lit(False))).alias("later_query"),
        (F.max("s_change") > F.min("s_create")).alias("later_session"),
    )
    temporary = F.col("later_query") | F.coalesce(F.col("later_session"), F.lit(False))
    latest = F.max_by(F.struct("c", "d", temporary.alias("replaced")), "logdate")
    return per_day.groupBy("ObjectTableName").agg(
        F.bool_and("blank").alias("all_blank"), latest.alias("day"),
    ).select(
        "ObjectTableName", "all_blank", F.col("day.c").alias("creates"),
        F.col("day.d").alias("changes"), F.col("day.replaced").alias("replaced"))


def temporary_tables(usage: DataFrame) -> DataFrame:
    """Tables whose latest day has a create and a matching later drop or rename."""
    return table_facts(usage).filter(
        F.col("creates") & F.col("changes") & F.col("replaced")).select("ObjectTableName")


def table_classes(usage: DataFrame) -> DataFrame:
    """(ObjectTableName, Table_Classification)."""
    label = (
        F.when(F.col("all_blank"), ACTIVE)
        .when(~F.col("creates") & F.col("changes"), ISOLATED)
        .when(F.col("creates") & F.col("changes") & F.col("replaced"), TEMPORARY)
        .otherwise(ACTIVE)
    )
    return table_facts(usage).select("ObjectTableName", label.alias("Table_Classification"))


def label_rows(usage: DataFrame, classes: DataFrame) -> DataFrame:
    """Every row with the class of its table; rows without a table name are active."""
    return usage.join(classes, "ObjectTableName", "left").select(
        *usage.columns,
        F.coalesce("Table_Classification", F.lit(ACTIVE)).alias("Table_Classification"))


def classify_tables(usage: DataFrame) -> DataFrame:
    """Label every row; the classes are stored first, for the same reason as the latest dates."""
    return label_rows(usage, store(table_classes(usage), "table-classes"))
