"""Relational queries over entities (pages), directed edges (follows) and facts (activity log).

Every function is generic over column names. Counts follow the rule "rows whose first field is
null are not counted", which is why the field to count is an argument; a null key still forms a
group. Grouping always pre-aggregates on the map side, so a key holding a large share of the rows
costs one partial row per task and not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinset.operators.hubs import frequent_values, join_spread
from skeinset.session import cut_lineage

BROADCAST_KEYS = 100_000


def count_by(facts: DataFrame, key: str, first_field: str | None = None, n: str = "n") -> DataFrame:
    """``key, n``: rows per key, skipping rows whose ``first_field`` is null."""
    counted = F.col(first_field) if first_field else F.lit(1)
    return facts.groupBy(key).agg(F.count(counted).alias(n))


def top_by_count(
    facts: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    out_cols: Sequence[str],
    n: int = 10,
    first_field: str | None = None,
) -> DataFrame:
    """``out_cols`` of the ``n`` entities with most facts; equal counts go by ``dim_key``.

    Keys unknown to ``dim`` drop out before the limit, for which its ids alone are shuffled. The
    columns asked for are then fetched for the ``n`` keys left. Sort and limit together become one
    bounded heap per task.
    """
    counts = count_by(facts, key, first_field, n="__n").withColumnRenamed(key, "__key")
    ids = dim.select(F.col(dim_key).alias("__id"))
    known = counts.join(ids, F.col("__key") == F.col("__id"), "left_semi")
    top = known.orderBy(F.desc("__n"), F.asc("__key")).limit(n)
    joined = dim.join(F.broadcast(top) if n <= BROADCAST_KEYS else top, F.col("__key") == F.col(dim_key))
    return joined.orderBy(F.desc("__n"), F.asc(dim_key)).limit(n).select(*out_cols)


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` equals ``value``; the predicate reaches the scan."""
    return df.filter(F.col(column) == F.lit(value))


def count_with_details(
    facts: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    first_field: str | None = None,
    owner: str = "owner",
    n: str = "n",
) -> DataFrame:
    """``owner, n`` and all columns of ``dim``; entities without facts are left out."""
    counts = count_by(facts, key, first_field, n).withColumnRenamed(key, owner)
    return counts.join(dim, F.col(owner) == F.col(dim_key))


def total_and_distinct(
    facts: DataFrame, key: str, value: str, first_field: str | None = None
) -> DataFrame:
    """``key, n, n_distinct``: rows and distinct non-null values per key.

    One aggregate does both. Spark spreads the distinct step over (key, value) before it meets
    the key alone, so a hot key is split.
    """
    counted = F.col(first_field) if first_field else F.lit(1)
    return facts.groupBy(key).agg(
        F.count(counted).alias("n"), F.count_distinct(F.col(value)).alias("n_distinct")
    )


def above_average(
    facts: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    out_cols: Sequence[str],
    first_field: str | None = None,
    owner: str = "owner",
    n: str = "n",
) -> DataFrame:
    """``owner, out_cols, n`` of entities counted strictly more often than the mean entity.

    The mean runs over the keys that occur, null among them. Rows with a null key are counted on
    their own: a scan that statistics cut to nothing where there are none. What is left of the
    mean is a scalar subquery over the very grouped rows the join reads, so Spark shuffles the
    facts once.
    """
    keyed = facts.filter(F.col(key).isNotNull())
    counts = count_by(keyed, key, first_field, n).withColumnRenamed(key, owner)
    counted = F.count(F.col(first_field) if first_field else F.lit(1))
    unkeyed = facts.filter(F.col(key).isNull()).agg(F.struct(counted.alias("n"), F.count(F.lit(1)).alias("rows")))
    grouped = counts.agg(F.struct(F.sum(n).alias("n"), F.count(F.lit(1)).alias("keys")))
    both, none = grouped.scalar(), unkeyed.scalar()
    keys = both["keys"] + F.when(none["rows"] > 0, F.lit(1)).otherwise(F.lit(0))
    kept = counts.filter(F.col(n) > F.try_divide(both["n"] + none["n"], keys))
    return kept.join(dim, F.col(owner) == F.col(dim_key)).select(owner, *out_cols, n)


def inactive(
    dim: DataFrame,
    dim_key: str,
    facts: DataFrame,
    key: str,
    time: str,
    cutoff: Column | int,
    out_cols: Sequence[str],
) -> DataFrame:
    """``out_cols`` of entities with no fact, or whose last fact is at or before ``cutoff``.

    Said the other way round: entities without a fact later than ``cutoff``. In that form the
    time bound reaches the scan, so only recent facts are read and no maximum is computed.
    """
    limit = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    recent = facts.filter(F.col(time) > limit).select(F.col(key).alias("__active")).distinct()
    return dim.join(recent, F.col(dim_key) == F.col("__active"), "left_anti").select(*out_cols)


def one_way_same_group(
    edges: DataFrame,
    src: str,
    dst: str,
    nodes: DataFrame,
    node_id: str,
    group: str,
    out_cols: Sequence[str],
    hubs: bool = False,
) -> DataFrame:
    """Distinct ``out_cols`` of nodes with an edge, not returned, to a node of their own group.

    One aggregate per unordered pair tells which directions it has, so edges are shuffled once and only
    one-way links, of ids alone, meet the nodes; ``out_cols`` are fetched for the sources that remain.
    An edge from a node to itself is its own return.

    ``hubs=True`` is for graphs where few nodes have a large share of the links, and does not rely on adaptive
    execution: one-way links are written out, sketches name the frequent ends, and only links of these are spread.
    """
    ends = nodes.select(F.col(node_id).alias("__id"), F.col(group).alias("__group"))
    a, b = F.col(src), F.col(dst)
    one_way = (
        edges.filter(a.isNotNull() & b.isNotNull())
        .groupBy(F.least(a, b).alias("__low"), F.greatest(a, b).alias("__high"))
        .agg(F.bool_or(a <= b).alias("__up"), F.bool_or(a >= b).alias("__down"))
        .filter(F.col("__up") != F.col("__down"))
    )
    up, low, high = F.col("__up"), F.col("__low"), F.col("__high")
    links = one_way.select(F.when(up, low).otherwise(high).alias("__src"), F.when(up, high).otherwise(low).alias("__dst"))
    tail = ends.select(F.col("__id").alias("__src"), F.col("__group").alias("__g"))
    head = ends.select(F.col("__id").alias("__dst"), F.col("__group").alias("__h"))
    if hubs:
        links = cut_lineage(links)
        hot = frequent_values(links, "__dst")
        known = join_spread(links, tail, "__src", ["__dst"])
        met = join_spread(known, head, "__dst", ["__src"], hot)
    else:
        met = links.join(tail, "__src").join(head, "__dst")
    inside = met.filter(F.col("__g") == F.col("__h"))
    sources = inside.select("__src", "__h").distinct()
    return (
        sources.join(nodes, (F.col("__src") == F.col(node_id)) & (F.col("__h") == F.col(group)))
        .select(*out_cols)
        .distinct()
    )
