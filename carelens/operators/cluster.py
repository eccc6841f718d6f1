"""Distances between sites and complete-linkage clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.sources.staging import stage


def unit_profiles(wide: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Centred unit vector of each site over the features known at every site."""
    sizes = wide.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"c_{i}") for i, c in enumerate(features)])
    row = sizes.select(F.struct(*sizes.columns)).scalar()
    kept = F.array_compact(
        F.array(
            *[
                F.when(F.col(f"_k.c_{i}") == F.col("_k.n"), F.col(c).cast("double"))
                for i, c in enumerate(features)
            ]
        )
    )
    raw = wide.withColumn("_k", row).select(key, kept.alias("_v"))

    def total(array):
        return F.aggregate(array, F.lit(0.0), lambda acc, v: acc + v)

    mean = F.try_divide(total(F.col("_v")), F.size("_v"))
    centred = raw.withColumn("_m", mean).withColumn("_v", F.transform("_v", lambda v: v - F.col("_m")))
    length = F.sqrt(total(F.transform("_v", lambda v: v * v)))
    return centred.withColumn("_l", length).select(
        key, F.transform("_v", lambda v: F.try_divide(v, F.col("_l"))).alias("profile")
    )


TILE = 2_000  # sites on a side of a tile
LEAST_BLOCKS = 8


def corr_distance(wide: DataFrame, key: str, features: list[str], blocks: int | None = None) -> DataFrame:
    """1 - Pearson correlation for every pair of sites.

    The pairs are the result.  They are formed block by block: each site goes
    to the block pairs it belongs to, an ordinary equi-join on the block pair
    brings them together, and each pair is formed once, in one task of many.
    The number of blocks follows the number of sites, so that a tile has about
    ``TILE`` sites on a side; ``blocks`` sets it.
    """
    profiles = stage(unit_profiles(wide, key, features), "profiles")  # one row per site
    if blocks is None:
        blocks = max(LEAST_BLOCKS, -(-profiles.count() // TILE))
    profiles = profiles.withColumn("_b", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
    rows = profiles.select(
        F.col(key).alias("_p"), F.col("profile").alias("_u"), F.col("_b").alias("_i"),
        F.explode(F.sequence(F.col("_b"), F.lit(blocks - 1))).alias("_j"),
    )
    cols = profiles.select(
        F.col(key).alias("_q"), F.col("profile").alias("_w"), F.col("_b").alias("_j"),
        F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_i"),
    )
    pairs = rows.join(cols, ["_i", "_j"]).filter((F.col("_i") < F.col("_j")) | (F.col("_p") < F.col("_q")))
    dot = F.aggregate(F.zip_with("_u", "_w", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    return pairs.select(
        F.least("_p", "_q").alias("site_a"), F.greatest("_p", "_q").alias("site_b"), (1 - dot).alias("distance")
    )


def hclust_complete(distances: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Complete-linkage clustering: (merges, leaf order).

    In each round all pairs of clusters that are each other's nearest
    neighbour are merged at once.  Complete linkage is reducible, so the tree
    is the one that merging pair by pair gives; ties go to the smaller id.
    A cluster carries the smallest id of its members, and the branch with the
    smaller id comes first in the leaf order.  A missing distance is an error.
    """
    flat = F.raise_error(F.lit("a site with equal features has no correlation with others, and no place in the tree"))
    known = F.when(F.isnan("distance"), None).otherwise(F.col("distance"))
    links = stage(distances.select("site_a", "site_b", F.coalesce(known, flat.cast("double")).alias("d")), "links")
    ends = links.select(F.col("site_a").alias("site")).union(links.select(F.col("site_b").alias("site"))).distinct()
    members = ends.select("site", F.col("site").alias("cluster"), F.lit(1).cast("bigint").alias("position"))
    merges = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("site_b").alias("site_a"), F.col("site_a").alias("site_b"), "d"))
        nearest = both.groupBy("site_a").agg(F.min_by(F.struct("site_b", "d"), F.struct("d", "site_b")).alias("_m"))
        nearest = nearest.select("site_a", "_m.site_b", "_m.d")
        back = nearest.select(F.col("site_b").alias("site_a"), F.col("site_a").alias("site_b"))
        joined = stage(nearest.join(back, ["site_a", "site_b"]).filter(F.col("site_a") < F.col("site_b")), "merges")
        merges = joined if merges is None else merges.unionByName(joined)

        moves = joined.select(F.col("site_b").alias("_from"), F.col("site_a").alias("_to"))
        renamed = links
        for end in ("site_a", "site_b"):
            renamed = renamed.join(moves.withColumnRenamed("_from", end), end, "left").withColumn(
                end, F.coalesce("_to", end)
            ).drop("_to")
        links = stage(
            renamed.filter(F.col("site_a") != F.col("site_b"))
            .groupBy(F.least("site_a", "site_b").alias("site_a"), F.greatest("site_a", "site_b").alias("site_b"))
            .agg(F.max("d").alias("d")),
            "links",
        )
        sizes = members.groupBy(F.col("cluster").alias("_to")).agg(F.count(F.lit(1)).alias("_shift"))
        shifts = moves.join(sizes, "_to").withColumnRenamed("_from", "cluster")
        members = stage(
            members.join(shifts, "cluster", "left").select(
                "site",
                F.coalesce("_to", "cluster").alias("cluster"),
                (F.col("position") + F.coalesce("_shift", F.lit(0))).alias("position"),
            ),
            "members",
        )
    if merges is None:
        merges = links
    merges = merges.select(F.col("site_a").alias("kept"), F.col("site_b").alias("absorbed"), F.col("d").alias("height"))
    return merges, members.select("site", "position")


def heat_rows(wide: DataFrame, key: str, features: list[str], leaves: DataFrame) -> DataFrame:
    """Long standardised values with the leaf position of their site."""
    long = wide.unpivot([key], features, "feature", "value")
    return long.join(leaves.withColumnRenamed("site", key), key)
