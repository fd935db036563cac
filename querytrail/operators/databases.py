"""Table -> database resolution over lineage rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.operators.mapping import keep_first
from querytrail.schemas import LINEAGE_KEY
from querytrail.session import store

UNKNOWN = "Unknown"


def unique_lineage(lineage: DataFrame, order: list[str]) -> DataFrame:
    """One row per lineage key (the seven columns as far as present), the first one kept."""
    return keep_first(lineage, [c for c in LINEAGE_KEY if c in lineage.columns], order)


def _sides(lineage: DataFrame, pos: str) -> DataFrame:
    """(side, table_name, database_name, pos) of every named source and target table."""
    def side(name: str) -> DataFrame:
        database = F.col(f"{name}_db") if f"{name}_db" in lineage.columns else F.lit(None)
        return lineage.select(
            F.lit(name).alias("side"), F.col(f"{name}_table").alias("table_name"),
            database.cast("string").alias("database_name"), F.col(pos).alias("pos"),
        )

    return side("source").unionByName(side("target")).filter(
        F.col("table_name").isNotNull() & (F.col("table_name") != ""))


def lineage_databases(lineage: DataFrame, pos: str) -> DataFrame:
    """(side, table_name, lineage_db) of all tables in the rows; lineage_db may be null.

    Distinct (table, database) pairs are taken in order of first appearance and the last of them
    wins. Both steps combine rows before their shuffle.
    """
    pairs = _sides(lineage, pos).groupBy("side", "table_name", "database_name").agg(
        F.min("pos").alias("first_pos"))
    named = F.when(F.col("database_name").isNotNull(), F.col("first_pos"))
    return pairs.groupBy("side", "table_name").agg(
        F.max_by("database_name", named).alias("lineage_db"))


def known_databases(table_map: DataFrame, pos: str) -> DataFrame:
    """(table_name, map_db) of a saved map; the first row of a table wins."""
    valid = table_map.filter(
        F.col("table_name").isNotNull() & F.col("database_name").isNotNull())
    return valid.groupBy("table_name").agg(F.min_by("database_name", pos).alias("map_db"))


def build_table_map(
    lineage: DataFrame, table_map: DataFrame, pos: str, map_pos: str
) -> DataFrame:
    """(side, table_name, database_name): lineage values first, then the saved map.

    Tables of the saved map apply to both sides; unresolved tables are left out.
    """
    saved = known_databases(table_map, map_pos)
    both_sides = saved.select(
        F.explode(F.array(F.lit("source"), F.lit("target"))).alias("side"), "table_name", "map_db")
    return (
        lineage_databases(lineage, pos).join(both_sides, ["side", "table_name"], "full_outer")
        .select("side", "table_name", F.coalesce("lineage_db", "map_db").alias("database_name"))
        .filter("database_name is not null")
    )


def tables_needing_lookup(
    lineage: DataFrame, table_map: DataFrame, pos: str, map_pos: str
) -> DataFrame:
    """(table_name, as_source, as_target) of tables without a database on that side."""
    saved = known_databases(table_map, map_pos)
    open_sides = lineage_databases(lineage, pos).filter("lineage_db is null").join(
        saved, "table_name", "left_anti")
    return open_sides.groupBy("table_name").agg(
        F.bool_or(F.col("side") == "source").alias("as_source"),
        F.bool_or(F.col("side") == "target").alias("as_target"),
    )


def catalog_databases(catalog: DataFrame) -> DataFrame:
    """(table_name, catalog_db): the database last accessed, ties broken by name."""
    used = catalog.filter("LastAccessTimeStamp is not null")
    return used.groupBy(F.col("tablename").alias("table_name")).agg(
        F.max_by("DatabaseName", F.struct("LastAccessTimeStamp", "DatabaseName"))
        .alias("catalog_db"))


def look_up(tables: DataFrame, catalog: DataFrame) -> DataFrame:
    """(table_name, database_name) from the catalog; `Unknown` where it has none.

    The catalog is combined to one row per table before the join, so a table with very many
    catalog rows costs one row per task.
    """
    wanted = tables.select("table_name").distinct()
    return wanted.join(catalog_databases(catalog), "table_name", "left").select(
        "table_name", F.coalesce("catalog_db", F.lit(UNKNOWN)).alias("database_name"))


def fill_databases(lineage: DataFrame, full_map: DataFrame) -> DataFrame:
    """Databases of both sides: map value, else the row's own; missing columns are created.

    `full_map` holds one row per (side, table), so rows are never multiplied.
    """
    out = lineage
    for side in ("source", "target"):
        names = full_map.filter(F.col("side") == side).select(
            F.col("table_name").alias("_table"), F.col("database_name").alias("_db"))
        own = F.col(f"{side}_db") if f"{side}_db" in lineage.columns else F.lit(None)
        out = (
            out.join(names, F.col(f"{side}_table") == F.col("_table"), "left")
            .withColumn(f"{side}_db", F.coalesce(F.col("_db"), own.cast("string")))
            .drop("_table", "_db")
        )
    return out


def resolve_databases(
    lineage: DataFrame, table_map: DataFrame, catalog: DataFrame, pos: str, map_pos: str
) -> tuple[DataFrame, DataFrame]:
    """Lineage rows with their databases, and the rows to append to the saved map.

    The map of the tables (one row per side and table) is stored on the way, so the lineage rows
    are read twice only: for the map and for the result.
    """
    sides = lineage_databases(lineage, pos)  # copies do not change it, so no dedup first
    known = store(
        sides.join(known_databases(table_map, map_pos), "table_name", "left").select(
            "side", "table_name", F.coalesce("lineage_db", "map_db").alias("known_db")),
        "known-databases")
    found = store(look_up(known.filter("known_db is null"), catalog), "found-databases")
    full_map = store(
        known.join(found, "table_name", "left").select(
            "side", "table_name", F.coalesce("known_db", "database_name").alias("database_name")),
        "database-map")
    return fill_databases(unique_lineage(lineage, [pos]), full_map), found


def new_pairs(current: DataFrame, global_map: DataFrame) -> DataFrame:
    """Distinct (db, table) pairs of this level that the global map does not hold."""
    return current.select("db", "table").distinct().join(
        global_map.select("db", "table"), ["db", "table"], "left_anti")


def unmapped_databases(merged: DataFrame, mapped: DataFrame) -> DataFrame:
    """Databases on either side of the merged rows that the global map does not know."""
    columns = [c for c in ("source_db", "target_db") if c in merged.columns]
    current = merged.select(F.explode(F.array(*columns)).alias("db")).filter("db is not null")
    return current.distinct().join(mapped.select("db"), "db", "left_anti")
