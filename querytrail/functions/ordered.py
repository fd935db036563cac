"""Order-dependent helpers that never put a whole group into one task.

Numbering cuts groups by ranges of positions. The neighbour helpers cut positions into buckets of
2**bits, so a window runs over (group, bucket) only; bucket totals are then added up per group. With
unique integer positions a bucket holds at most 2**bits rows however large its group is.

Group and bucket travel as one struct: it is never null itself, so null group keys stay a group,
and window, aggregate and join share one hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querytrail.session import store

BITS = 18


def _bucket(pos: str, bits: int) -> Column:
    return F.shiftright(F.col(pos).cast("long"), bits)


def _earlier_buckets():
    return Window.partitionBy("_keys").orderBy("_no").rowsBetween(Window.unboundedPreceding, -1)


def _per_bucket(cut: DataFrame, total: Column) -> DataFrame:
    return cut.groupBy("_group").agg(total.alias("_total")).select(
        F.col("_group").alias("_right"), F.col("_group.keys").alias("_keys"),
        F.col("_group.no").alias("_no"), "_total",
    )


def number_rows(df: DataFrame, keys: list[str], pos: str, out: str) -> DataFrame:
    """1-based number of each row inside its group, in order of the unique `pos`.

    Rows are dealt by ranges of (group, pos), so a group of any size and spacing is cut into parts of
    the usual partition size. Parts are numbered by themselves; a running total over the parts of a
    group, one row each, gives the rest. The input is computed once and stored.
    """
    dealt = store(
        store(df, "to-number").repartitionByRange(*keys, pos)
        .withColumn("_group", F.struct(F.struct(*keys).alias("keys"), F.spark_partition_id().alias("no"))),
        "ranges")
    before = _per_bucket(dealt, F.count("*")).select(
        "_right", F.coalesce(F.sum("_total").over(_earlier_buckets()), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_group").orderBy(pos)
    return (
        dealt.withColumn("_local", F.row_number().over(inside))
        .join(before, F.col("_group") == F.col("_right"))
        .withColumn(out, F.col("_before") + F.col("_local"))
        .select(*df.columns, out)
    )


def look_around(
    df: DataFrame, keys: list[str], pos: str, offsets: dict[int, list[tuple[str, Column]]],
    bits: int = BITS,
) -> DataFrame:
    """Values of the row `offset` positions away, for dense integer positions.

    `offsets` maps an offset (negative = behind) to (new column, expression) pairs. Each bucket
    also receives the few rows of its neighbours that its own rows look at, which needs one
    shuffle and no self-join.
    """
    ahead = max([o for o in offsets if o > 0], default=0)
    behind = -min([o for o in offsets if o < 0], default=0)
    bits = max(bits, max(ahead, behind).bit_length())  # a row looks into the next bucket at most
    width = 1 << bits
    no = _bucket(pos, bits)
    inside = F.col(pos).cast("long").bitwiseAND(F.lit(width - 1))

    def home(number: Column, own: bool) -> Column:
        return F.struct(number.alias("no"), F.lit(own).alias("own"))

    own, before, after = home(no, True), home(no - 1, False), home(no + 1, False)
    low, high = inside < ahead, inside >= width - behind
    homes = (
        F.when(low & high, F.array(own, before, after)).when(low, F.array(own, before))
        .when(high, F.array(own, after)).otherwise(F.array(own))
    )
    window = Window.partitionBy(*keys, "_home.no").orderBy(pos)
    added = {
        name: (F.lead(value, o) if o >= 0 else F.lag(value, -o)).over(window)
        for o, columns in offsets.items()
        for name, value in columns
    }
    spread = df.withColumn("_home", F.explode_outer(homes)).withColumns(added)
    return spread.filter("_home.own").drop("_home")


def odd_of_runs(df: DataFrame, keys: list[str], pos: str, bits: int = BITS) -> DataFrame:
    """Keep the 1st, 3rd, 5th ... row of each run of consecutive positions.

    This is the left-to-right choice of non-overlapping pairs when row `pos` uses up `pos + 1`.
    A bucket also receives the last position of the bucket before it, to see whether a run goes on.
    """
    at = F.col(pos)
    last_of_bucket = at.cast("long").bitwiseAND(F.lit((1 << bits) - 1)) == (1 << bits) - 1
    here = F.struct(F.struct(*keys).alias("keys"), _bucket(pos, bits).alias("no"))
    following = F.struct(F.struct(*keys).alias("keys"), (_bucket(pos, bits) + 1).alias("no"))
    homes = F.when(last_of_bucket, F.array(here, following)).otherwise(F.array(here))
    window = Window.partitionBy("_group").orderBy(pos)
    previous = F.lag(pos).over(window)
    own = F.col("_group.no") == _bucket(pos, bits)
    begins = previous.isNull() | (previous < at - 1)
    up_to_here = window.rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        df.withColumn("_group", F.explode_outer(homes))
        .withColumn("_start", F.when(begins & own, at))
        .withColumn("_local", F.max("_start").over(up_to_here)).filter(own)
    )
    carried = _per_bucket(rows, F.max("_start")).select(
        "_right", F.max("_total").over(_earlier_buckets()).alias("_carried"))
    run_start = F.coalesce("_local", "_carried")
    return (
        rows.join(carried, F.col("_group") == F.col("_right"))
        .filter((at - run_start) % 2 == 0).select(*df.columns)
    )
