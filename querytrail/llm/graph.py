"""Connected components of links, with every step a join or an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.session import store


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest node reachable.

    Each round every node learns the smallest grandparent among its neighbours, hands it to its
    parent, and jumps to its grandparent, so long chains close in logarithmically many rounds.
    Rounds go through stored tables: joins start from files, so a hub with very many links is split
    at run time, and a lost executor costs one round at most. Null ends and loops are left out.
    """
    ends = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    ends = ends.filter("a <> b")
    both = store(
        ends.union(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    first = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    state = store(_jump(store(
        first.select("node", F.least("node", "low").alias("parent")), "parents")), "labels")
    total = _total(state)
    while total is not None:
        state = store(_jump(store(_lower(both, state), "parents")), "labels")
        before, total = total, _total(state)
        if total == before:
            break
    return state.select("node", F.col("grand").alias("component"))


def _lower(both: DataFrame, state: DataFrame) -> DataFrame:
    """(node, parent): the smallest label that a node, its neighbours or its children know."""
    label = state.select(F.col("node").alias("b"), "grand")
    heard = both.join(label, "b").groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("heard"))
    known = state.join(heard, "node").withColumn("low", F.least("grand", "heard"))
    told = F.array(F.struct("node", "low"), F.struct(F.col("parent").alias("node"), "low"))
    return (
        known.select(F.explode(told).alias("t")).groupBy(F.col("t.node").alias("node"))
        .agg(F.min("t.low").alias("parent"))
    )


def _jump(parents: DataFrame) -> DataFrame:
    """(node, parent, grand) with the parent's parent."""
    above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
    return parents.join(above, "parent").select("node", "parent", "grand")


def _total(state: DataFrame):
    """Labels only fall, so an unchanged sum means that none has changed."""
    return state.agg(F.sum(F.col("grand").cast("decimal(20,0)"))).first()[0]
