"""Rules on hosts and path prefixes, judged by sorted sweeps over reversed-host keys.

A host written from its last label to its first, with a dot after each label, turns "this host and all
its subdomains" into a prefix, and a prefix into an interval of the sorted order. Intervals of prefixes
are nested or apart. A sweep over keys and interval ends in sorted order therefore keeps a stack: an
interval that opens is pushed, one that closes was on top. Here the stack is window functions: the
running number of open intervals is its height, and the latest interval opened at each level its content.

The first sweep runs over reversed hosts and gives each host all its rule hosts. The second runs over rule
host and path, and the top of its stack is the longest path rule of that host. Sweeps run in slices, each
with its share of the keys by a hash and all interval ends, so no key, frequent or not, makes a slice long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    found = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", group)
    return F.when(F.locate("://", url) > 0, found).otherwise(F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit("."))


def _key(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def _sweep(rows: DataFrame, prefixes: DataFrame, depth: int, slices: int, spread: list[str]) -> DataFrame:
    """``rows`` (with ``key``, binary) with ``stack``: ``item`` of all ``prefixes`` (``key``, ``item``, the keys
    all different) that ``key`` starts with, the shortest first. ``depth`` is the most that can be nested."""
    item = prefixes.schema["item"].dataType
    after_all = F.lit(b"\xff")  # no UTF-8 text has this byte
    dealt = prefixes.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    opens = dealt.select("slice", "key", F.lit(0).alias("kind"), "item")
    closes = dealt.select("slice", F.concat("key", after_all).alias("key"), F.lit(2).alias("kind"), "item")
    keyed = rows.select(
        F.pmod(F.xxhash64(*spread), F.lit(slices)).cast("int").alias("slice"),
        "key",
        F.lit(1).alias("kind"),
        F.lit(None).cast(item).alias("item"),
        F.struct(*[c for c in rows.columns if c != "key"]).alias("row"),
    )
    events = keyed.unionByName(opens.unionByName(closes), allowMissingColumns=True)
    so_far = Window.partitionBy("slice").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("kind") == 0, 1).when(F.col("kind") == 2, -1).otherwise(0)
    height = events.withColumn("height", F.sum(step).over(so_far).cast("int"))
    levels = [
        F.last(F.when((F.col("kind") == 0) & (F.col("height") == k), F.col("item")), ignorenulls=True).over(so_far)
        for k in range(1, depth + 1)
    ]
    stacked = height.withColumn("levels", F.array(*levels) if levels else F.array().cast(f"array<{item.simpleString()}>"))
    return stacked.filter("kind = 1").select("row.*", F.slice("levels", 1, F.col("height")).alias("stack"))


def judge(
    urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", slices: int | None = None
) -> DataFrame:
    """``urls`` with ``host, path, rule, verdict``; columns of these names are replaced.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all subdomains where the url's path
    starts with the rule's. Of several the one with the most characters wins, then the one with the longer
    host. Of one host and path given twice, the last verdict in alphabetical order holds (block before
    allow). Rules with a null are left out. Without a rule, ``rule`` is null and ``verdict`` the default;
    so it is for null urls and those without ``://``, whose host and path are empty.
    """
    spark = urls.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = urls.drop("host", "path", "rule", "verdict")
    parted = base.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    clean = (
        rules.dropna(subset=["host", "path", "verdict"])
        .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    hosts = clean.select("host").distinct().withColumn("key", _key(reversed_host(F.col("host"))))
    host_rules = hosts.select("key", F.struct("host").alias("item"))
    path_rules = clean.select(
        _key(F.concat(reversed_host(F.col("host")), F.lit("\x00"), "path")).alias("key"),
        F.struct("host", F.concat("host", "path").alias("rule"), "verdict").alias("item"),
    )
    labels = hosts.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).head()["n"] or 0
    distinct = parted.select("host", "path").distinct()
    pairs = ["host", "path"]
    under = _sweep(distinct.withColumn("key", _key(reversed_host(F.col("host")))), host_rules, labels, slices, pairs)
    opened = under.select(*pairs, F.explode("stack.host").alias("at"))
    keyed = opened.withColumn("key", _key(F.concat(reversed_host(F.col("at")), F.lit("\x00"), "path")))
    found = _sweep(keyed, path_rules, _nesting(clean), slices, [*pairs, "at"])
    top = found.filter(F.size("stack") > 0).select(*pairs, F.element_at("stack", -1).alias("best"))
    longest = F.struct(F.length("best.rule"), F.length("best.host"))
    best = top.groupBy(*pairs).agg(F.max_by("best", longest).alias("best"))
    return parted.join(best, pairs, "left").select(
        *base.columns, *pairs, F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def _nesting(rules: DataFrame) -> int:
    """The most path prefixes of one host that lie in each other."""
    opens = rules.select("host", _key(F.col("path")).alias("key"), F.lit(1).alias("step"))
    closes = rules.select("host", F.concat(_key(F.col("path")), F.lit(b"\xff")).alias("key"), F.lit(-1).alias("step"))
    so_far = Window.partitionBy("host").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    return opens.union(closes).select(F.sum("step").over(so_far).alias("n")).agg(F.max("n")).head()[0] or 0
