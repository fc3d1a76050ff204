"""Connected components of an edge table by alternating star steps.

Each round hangs every node's neighbours on the least node it sees; the number of rounds grows
slowly with the longest path.  Every round is written to the shared folder.  Nodes and edges stay in
tables; the driver sees a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresight.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, label): label is the least node of the component; nodes without an edge to
    another node are left out."""
    links = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(links.select("b", "b")).groupBy("node").agg(F.min("label").alias("label"))
        seen = state
        # every node's larger neighbours go to the least node of its neighbourhood
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()
        # then every node and its smaller neighbours to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).union(least).filter("a <> b").distinct()
        links = written(small, "links")
