"""Connected components of links that no one machine could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import forget, saved


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(
        F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
        .alias("l")
    ).select("l.a", "l.b")


def _large_star(links: DataFrame) -> DataFrame:
    """Join each node's larger neighbours to its least neighbour (or itself)."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    return near.where("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.least("a", "m").alias("b")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Join each node and its smaller neighbours to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    return joined.select(
        F.explode(
            F.array(
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            )
        ).alias("l")
    ).select("l.a", "l.b").where("a != b").distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node in ``links`` (columns ``a``, ``b``, long, undirected).

    ``root`` is the least node reachable. Alternating large and small stars: every pass is
    grouping with map-side minima and a join that adaptive execution may split, so the hub of a
    huge component is no hot task. Passes grow with the logarithm of the nodes. Each pass is
    written to the shared folder. Self links, repeated links and NULL ends are dropped; no links
    give no rows.
    """
    links = saved(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = _state(links)
    while state[0]:
        after = saved(_small_star(_large_star(links)), "links")
        forget(links)
        links, before = after, state
        state = _state(links)
        if state == before:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
