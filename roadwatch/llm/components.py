"""Connected components by alternating star contractions, all in joins and aggregates."""


from pyspark.sql import functions as F

from roadwatch.llm.tables import stored


def _large_star(edges):
    """Every larger neighbour of a vertex is tied to the least one around it; as many rows as edges, some may be repeated."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges):
    """A vertex and its smaller neighbours are tied to the least of them; not more rows than edges, some may be repeated."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", "m"))


def _are_stars(edges):
    """Whether no vertex is tied to two others, nor tied to one and others to it. Its least is then each star's centre."""
    ends = edges.select(F.col("u").alias("x"), F.col("v").alias("to"), F.lit(False).alias("centre")).union(
        edges.select("v", F.lit(None).cast("long"), F.lit(True))
    )
    met = ends.groupBy("x").agg(F.min("to").alias("a"), F.max("to").alias("b"), F.max("centre").alias("centre"))
    return met.filter("a <> b OR a IS NOT NULL AND centre").isEmpty()


def components(edges, rounds=None):
    """One row per vertex of `edges` (u, v): `u` and `v`, the least vertex of its component; roots are left out.

    Rounds are logarithmic in the longest path. Each round's edges are stored, so no lineage
    grows; only one row reaches the driver. With a number of `rounds`, v is a smaller vertex of the component
    that so many have reached, not always the least, and the rows need not connect the whole component.
    """
    larger = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(larger, "links")
    while rounds != 0 if rounds is not None else not _are_stars(edges):
        edges = stored(_small_star(stored(_large_star(edges), "large-star")), "small-star")
        rounds = rounds if rounds is None else rounds - 1
    return stored(edges.groupBy("u").agg(F.min("v").alias("v")), "labels")
