"""Connected components of an edge table, by alternating star contractions.

Every round links the larger neighbours of a node to its smallest one (large star), then the
smaller ones (small star), until nothing changes; the edges are then stars around each component's
smallest node.  Rounds grow with the logarithm of the longest chain, each is written to the shared
checkpoint folder, and only edges move, two columns wide.  A round is written in parts of at least
``PART_EDGES`` edges, as far as that keeps all cores busy: it never has more edges than the one before, and a part
for each shuffle partition would be mostly empty files.

A component's smallest node becomes the hub of all others.  A node with more than ``HUB_LINKS`` links and
more than one in ``HUBS`` of all is such a hub; there are at most ``HUBS`` at any size, so their list is
broadcast, their links are dealt over ``SALTS`` sub-keys and only their own row is copied to each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import checkpointed, part_count

HUB_LINKS = 500
HUBS = 4096
SALTS = 256
PART_EDGES = 100_000


def _star(edges: DataFrame, large: bool, hub: int) -> DataFrame:
    if large:
        arrows = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        arrows = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = arrows.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"), F.count(F.lit(1)).alias("links"))
    is_hub = F.col("links") > hub
    hubs = F.broadcast(least.where(is_hub).select("a", F.lit(True).alias("is_hub")))  # at most ``HUBS``, see ``components``
    salt = F.when(F.col("is_hub"), F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.explode(F.sequence(F.lit(0), F.when(is_hub, SALTS - 1).otherwise(0)))
    linked = arrows.join(hubs, "a", "left").withColumn("salt", salt).join(least.withColumn("salt", salts), ["a", "salt"])
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        # a node that is its own smallest neighbour keeps its larger ones; nothing is lost: (b, least) has them
    else:
        out = linked.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.where("a <> least").select("a", F.col("least").alias("b")))
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of ``edges`` (``a``, ``b``, one ordered type, no nulls);
    a component is named by its smallest node."""
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .distinct())
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        hub = max(HUB_LINKS, 2 * state[0] // HUBS)  # every link is seen from both ends
        parts = part_count(edges.sparkSession, state[0], PART_EDGES)
        edges = checkpointed(_star(_star(edges, True, hub), False, hub).coalesce(parts))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
