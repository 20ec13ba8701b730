"""Seeded generators for the inputs, built on ``spark.range`` so that any size is generated in parallel.

Every value is a hash of the row number, a stream number and the seed: the same call gives the
same rows however they are partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ranges of the four coordinates, both ends included.
POINT_RANGES = ((0, 10000), (20000, 1000000), (0, 20000), (0, 30000))

# Sizes and ranges of the social network.
PAGES = 100_000
FOLLOWS = 40_000
ACTIVITIES = 20_000_000
REGIONS = 50
LAST_TIME = 1_000_001

# Word lists.
NICKNAMES = [
    "CeciHerriman1", "CharlesH123", "JimmyJim99", "LaurieMango99", "KyraBrown30", "MountLandyn",
    "PatriceBergy", "BradMarch63", "IsabelSmailey", "CliffordRed", "GabyNags11", "100Charlie249er",
    "Spidey1010x",
]
JOBS = ["Software Engineer", "Data Scientist", "Senior Manager", "Director of Software", "Test Engineer"]
HOBBIES = [
    "Sewing", "Hockey", "Reading", "Cooking", "Painting", "Skydiving", "Soccer", "Lifting", "Working out",
]
DESCRIPTIONS = [
    "Best friends in college",
    "Best friends in high school",
    "Close family friend",
    "Professional celebrity interest",
    "We met during our sophomore year study group",
    "Close friend from college engineering classes",
    "Roommate from my university years",
    "My cousin who I grew up with",
]
ACTIONS = [
    "Just viewing the page",
    "Viewed page - left a note",
    "Viewed page - followed user",
    "Viewed page - liked and commented on post",
]
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def _draw(seed: int, stream: int, low: int, high: int) -> Column:
    """A whole number from ``low`` to ``high``, both included."""
    hashed = F.xxhash64(F.col("id"), F.lit(stream), F.lit(seed))
    return F.pmod(hashed, F.lit(high - low + 1).cast("bigint")) + F.lit(low)


def _pick(seed: int, stream: int, words: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), _draw(seed, stream, 1, len(words)).cast("int"))


def _letters(seed: int, stream: int, length: int) -> Column:
    signs = F.transform(
        F.sequence(F.lit(1), F.lit(length)),
        lambda i: F.substring(
            F.lit(LETTERS),
            (F.pmod(F.xxhash64(F.col("id"), i, F.lit(stream), F.lit(seed)), F.lit(len(LETTERS))) + 1).cast("int"),
            F.lit(1),
        ),
    )
    return F.array_join(signs, "")


def _other(seed: int, stream: int, taken: Column, n: int) -> Column:
    """A whole number from 1 to ``n``, uniform among those that are not ``taken``."""
    step = _draw(seed, stream, 1, n - 1)
    return F.pmod(taken - 1 + step, F.lit(n).cast("bigint")) + 1


def points(spark: SparkSession, n: int = 6000, seed: int = 0) -> DataFrame:
    """``id, w, x, y, z``."""
    coords = [
        _draw(seed, i, low, high).cast("double").alias(name)
        for i, (name, (low, high)) in enumerate(zip("wxyz", POINT_RANGES))
    ]
    return spark.range(n).select("id", *coords)


def seed_points(spark: SparkSession, k: int, seed: int = 0) -> DataFrame:
    """``cid, c``: ``k`` starting centroids from the ranges of the points."""
    vector = [_draw(seed, 10 + i, low, high).cast("double") for i, (low, high) in enumerate(POINT_RANGES)]
    return spark.range(k).select(F.col("id").alias("cid"), F.array(*vector).alias("c"))


def pages(spark: SparkSession, n: int = PAGES, seed: int = 0) -> DataFrame:
    """Half of the rows take their texts from the lists, the others are random letters."""
    listed = _draw(seed, 20, 0, 1) == 1
    texts = [
        F.when(listed, _pick(seed, 21 + i, words)).otherwise(_letters(seed, 24 + i, 15)).alias(name)
        for i, (name, words) in enumerate(
            (("userNickname", NICKNAMES), ("userJob", JOBS), ("userHobby", HOBBIES))
        )
    ]
    return spark.range(1, n + 1).select(
        F.col("id").cast("int").alias("id"),
        texts[0],
        texts[1],
        _draw(seed, 27, 1, REGIONS).cast("int").alias("userRegionCode"),
        texts[2],
    )


def follows(spark: SparkSession, n: int = FOLLOWS, users: int = PAGES, seed: int = 0) -> DataFrame:
    """Edges between different users."""
    source = _draw(seed, 30, 1, users)
    text = F.when(_draw(seed, 33, 0, 1) == 1, _pick(seed, 34, DESCRIPTIONS)).otherwise(_letters(seed, 35, 40))
    return spark.range(1, n + 1).select(
        F.col("id").cast("int").alias("colRel"),
        source.cast("int").alias("id1"),
        _other(seed, 31, source, users).cast("int").alias("id2"),
        _draw(seed, 32, 1, LAST_TIME).cast("int").alias("date"),
        text.alias("desc"),
    )


def activity(spark: SparkSession, n: int = ACTIVITIES, users: int = PAGES, seed: int = 0) -> DataFrame:
    """Log rows; nobody visits their own page."""
    actor = _draw(seed, 40, 1, users)
    text = F.when(_draw(seed, 43, 0, 1) == 1, _pick(seed, 44, ACTIONS)).otherwise(_letters(seed, 45, 40))
    return spark.range(1, n + 1).select(
        F.col("id").cast("int").alias("logId"),
        actor.cast("int").alias("byWho"),
        _other(seed, 41, actor, users).cast("int").alias("whatPage"),
        text.alias("actionType"),
        _draw(seed, 42, 1, LAST_TIME).cast("int").alias("time"),
    )
