"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid.session import materialize


#: Links of one node that meet in a task, at least; those of a node with more are dealt over several.
NODE_LINKS = 100_000
#: A node has more than this part of all links before it is dealt, so such nodes are at most as many.
LARGE_NODES = 1000


def _with_low(links: DataFrame, low: Column, node_links: int) -> tuple[DataFrame, DataFrame]:
    """The links (u, v) with `low`, an aggregate over the links of `u`, and the table of `low`.

    A node of many links (the centre of a large star) is dealt by the hash of the
    other end: its aggregate, one row, is repeated for each of its shares. Links
    learn their node's number of shares from a broadcast of the large nodes, which
    are `LARGE_NODES` at most by their definition.
    """
    all_links, most = links.groupBy("u").count().agg(F.sum("count"), F.max("count")).first()
    limit = max(node_links, (all_links or 0) // LARGE_NODES)
    lows = links.groupBy("u").agg(low.alias("low"), F.ceil(F.count("*") / limit).cast("int").alias("shares"))
    if (most or 0) <= limit:
        return links.join(lows.drop("shares"), "u"), lows
    counted = links.join(F.broadcast(lows.where("shares > 1").select("u", "shares")), "u", "left")
    dealt = counted.select("u", "v", F.pmod(F.xxhash64("v"), F.coalesce("shares", F.lit(1))).cast("int").alias("share"))
    repeated = lows.select("u", "low", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    return dealt.join(repeated, ["u", "share"]).drop("share"), lows


def components(links: DataFrame, a: str = "a", b: str = "b", node_links: int = NODE_LINKS) -> DataFrame:
    """The component of each linked node, named by its smallest node: columns node, component.

    Each round does two steps. Large star: every node links its larger neighbours
    to its smallest one. Small star: every node links itself and its smaller
    neighbours to the smallest of them. Links never leave their component, and a
    round that changes nothing has made each component a star around its smallest
    node. Rounds grow with the logarithm of the longest path. Every step is a
    grouped minimum and a join, so no list of neighbours is gathered; links of a
    node that has many are dealt over several tasks; each round is stored in the
    shared folder.
    """
    edges = materialize(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        starred, _ = _with_low(both, F.least(F.min("v"), F.first("u")), node_links)
        large = materialize(starred.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct())
        # In `large` every link points from its larger end to its smaller one.
        down, lows = _with_low(large, F.min("v"), node_links)
        edges = materialize(
            down.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(lows.select("u", F.col("low").alias("v"))).where("u <> v").distinct()
        )
        # A table of links is told by its size and hash.
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
