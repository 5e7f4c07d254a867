"""Connected components of an edge table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop, stash


def connected_components(edges: DataFrame, left: str = "a", right: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node
    reachable.  Nodes may be of any ordered type.

    Alternates large-star and small-star steps (each node's larger, then its
    smaller neighbours move to the least neighbour).  Each round is written to
    shared storage, so lineage stays short.  A hub's edges meet its minimum by
    an equi-join, which adaptive execution splits where a node holds many
    edges.  Null ends and self-loops are dropped; an empty table gives an
    empty result.
    """
    e = (
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
        .distinct()
    )
    e = stash(e, "cc")
    before = None
    for _ in range(max_rounds):
        # large star: every node hands its larger neighbours to its minimum
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        big = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, e = e, stash(big.where("u != v").distinct(), "cc")
        drop(old)
        # small star: every node hands its smaller neighbours to its minimum
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        small = e.join(least, "u")
        old, e = e, stash(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where("u != v")
            .distinct(),
            "cc",
        )
        drop(old)
        # stars only: no node is both a root and a leaf
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == (now["n"], now["h"]):
            break
        before = (now["n"], now["h"])
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def join_members(rows: DataFrame, per_root: DataFrame, members: str, parts: int = 16) -> DataFrame:
    """``rows`` (key, root, ...) with the columns that ``per_root`` has for each
    root; ``members`` is its column with the number of keys of a root.

    Each root is among the keys.  Rows of a root itself meet it alone; the others
    are dealt by key to ``parts`` copies of the roots that have several, so the
    members of a large component do not gather in one task.
    """
    own = rows.where("root = key").join(per_root, "root")
    several = per_root.where(F.col(members) > 1).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    others = rows.where("root != key").withColumn("_part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    return own.unionByName(others.join(several, ["root", "_part"]).drop("_part")).drop(members)
