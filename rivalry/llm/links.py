"""Connected components of a link table, as a chain of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.session import stored


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for the nodes of ``links`` (a, b), both long.

    Large-star and small-star steps alternate: every node hands its larger neighbours, then its
    smaller ones, to the least node it knows of. The table never grows; each round is stored in
    the shared folder, and a round that changes nothing ends it. A node with very many links is
    an aggregate on the map side and a join that Spark splits. Links of a node to itself and
    nulls are ignored; no links give no rows.
    """
    table = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct()
    )
    state = None
    while True:
        new = table.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if new == state or not new[0]:
            return table.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                table.select("v", "v").distinct()
            )
        state = new
        both = table.union(table.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        table = stored(small.union(least).distinct())
