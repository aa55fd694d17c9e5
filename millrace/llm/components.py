"""Connected components of links, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import stored


def _settled(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and that one has none. Counts are summed where links are read."""
    down = links.select(F.col("u").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger"))
    ends = down.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("smaller"), F.lit(1).alias("larger")))
    ends = ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return not ends.where("smaller > 1 OR smaller = 1 AND larger = 1").count()


def components(links: DataFrame) -> DataFrame:
    """(u, v) with v the smallest id reachable from u, for every u that is not itself the smallest. Links are pairs (u, v).

    Alternates two steps until every node is linked to the smallest alone, each time with the links written out: every node sends its larger
    neighbours to the smallest one it knows, then its smaller neighbours. Only minima are gathered for a node, never its neighbours.
    """
    links = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _settled(links):
        # the smallest neighbour is among the smaller ones, and a node without such is itself the smallest it knows
        least = links.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        larger = links.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(smaller.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return links
