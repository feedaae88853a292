"""Connected components of a link table, as Spark joins and aggregations.

Each round maps every node to the smallest of itself and its neighbours and
rewrites the links by that map; links inside one node vanish. Node keys are
expected to be in no particular order (here they are digests), so the number of
rounds grows with the logarithm of the longest path. A node with very many
links is only ever aggregated with map-side combination or joined from stored
tables, whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 200) -> DataFrame:
    """(node, root) for every node that has a link; root is the same for all
    nodes of a component. Self-links, repeated links and links with a null end
    change nothing. An empty table gives an empty table."""
    edges = stored(links.where(F.col(a) != F.col(b)).select(F.col(a).alias("a"), F.col(b).alias("b")).distinct(), "cc-links")
    root = None
    for _ in range(most_rounds):
        if edges.isEmpty():
            break
        both = edges.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))))
        up = stored(both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("to")), "cc-up")
        # where the target itself points: one hop more in the same round
        hop = stored(up.join(up.select(F.col("node").alias("to"), F.col("to").alias("far")), "to", "left").select("node", F.coalesce("far", "to").alias("to")), "cc-hop")
        edges = stored(
            edges.join(hop.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a")
            .join(hop.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b")
            .where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(),
            "cc-links",
        )
        if root is None:
            root = hop.select("node", F.col("to").alias("root"))
        else:
            step = hop.select(F.col("node").alias("root"), F.col("to").alias("next"))
            root = stored(root.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "cc-root")
    else:
        raise RuntimeError("components did not settle")
    if root is None:
        kind = edges.schema["a"].dataType
        return edges.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("root"))
    return root
