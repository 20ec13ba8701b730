"""Connected components of links that stay in tables, by alternating large and small stars.

Each round points all neighbours of a node to the smallest node it knows, first those above the
node, then those below. Rounds grow with the logarithm of the number of nodes. A hub only meets a
pre-aggregated minimum and a salted join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinset.llm.common import keep, release, salted_join


def _pointed(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _pointed(salted_join(both.filter("b > a"), least, "a", "b").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = salted_join(down, least, "a", "b").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _pointed(moved.union(least.select("a", F.col("m").alias("b"))))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a, b`` of one type) but the roots themselves.

    ``root`` is the smallest node that can be reached. Links with a null end are ignored.
    """
    edges = keep(_pointed(links.filter("a is not null and b is not null")), "links")
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if now == seen or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
        after = keep(_small_star(_large_star(edges)), "links")
        release(edges)
        edges = after
