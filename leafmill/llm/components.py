"""Connected components of a graph given by its edges, in rounds of two star steps.

Only pairs are moved: no neighbour list is gathered, so a node with very many neighbours is a
partial minimum and a join that adaptive execution can split. The rounds grow with the logarithm
of the longest chain; each is written to the shared scratch folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.common import stored


def _pairs(high: Column, low: Column) -> list[Column]:
    return [F.greatest(high, low).alias("u"), F.least(high, low).alias("v")]


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to its smallest neighbour, or to itself if that is smaller."""
    both = pairs.select(F.col("u").alias("x"), F.col("v").alias("y"))
    both = both.union(pairs.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``a, b``: the smallest node that links lead to.

    Edges may repeat and run either way; a node tied to itself alone is its own component. No edges: no rows.
    """
    known = edges.filter("a is not null and b is not null")
    pairs = stored(known.select(*_pairs(F.col("a"), F.col("b"))).distinct(), "links")
    loops = pairs.filter("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    links, before = pairs.filter("u != v"), None
    while (now := _state(links)) != before and now[0]:
        before = now
        links = stored(_small_star(_large_star(links)), "stars")
    named = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return named.union(roots).union(loops.join(named.union(roots), "node", "left_anti"))
