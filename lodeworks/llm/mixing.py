"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size.  The sources share a total in proportion
to their weights; a source whose share exceeds ``max_epochs`` times its size is
clamped there and what it cannot take is shared again among the others, until
no share is above its cap.  A document is then taken ``whole`` times, and once
more if its seeded hash falls below its source's cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import stash

#: Hash buckets per source when a cut is looked for (a parameter of the search,
#: not of its result: the bucket that holds the cut is resolved row by row).
CUT_BUCKETS = 4096
#: At most this many sources are broadcast; a larger source table is joined by key.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and characters 9 to 13; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(key: Column, seed: int) -> Column:
    """A seeded uniform integer in [0, 2**48), the same in any engine with MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 12), 16, 10).cast("long")


def rank_weights(sources: DataFrame, source: str, weights: Sequence[int]) -> DataFrame:
    """Adds ``w``: the weights, repeating, over sources by code point, null last.

    A global sort numbers the sources: place within the partition plus a base
    from the partitions' counts, so no task sees all sources.
    """
    ordered = stash(sources.orderBy(F.col(source).asc_nulls_last()).withColumn("_id", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("_id", 33)
    counts = ordered.groupBy(part.alias("_part")).count().orderBy("_part").collect()  # one row a partition
    bases, n = {}, 0
    for row in counts:
        bases[row["_part"]] = n
        n += row["count"]
    spark = sources.sparkSession
    table = spark.createDataFrame([(k, v) for k, v in bases.items()] or [(0, 0)], "_part int, _base long")
    place = F.col("_base") + F.col("_id").bitwiseAND((1 << 33) - 1)
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    return ordered.withColumn("_part", part.cast("int")).join(F.broadcast(table), "_part").withColumn("w", pick).drop("_part", "_base", "_id")


def water_fill(sources: DataFrame, max_epochs: float, share: float = 1.0) -> DataFrame:
    """Adds ``target`` to a table with columns ``w`` and ``source_size``.

    Each round is one global aggregate of two sums: what clamped sources take
    and the weight of the others.  The level only rises, so a clamped source
    stays clamped; the loop ends when a round clamps no further source.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = sources.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    goal, level, clamped = float(total) * share, 0.0, -1
    while True:
        over = F.lit(clamped >= 0) & (F.col("w") * F.lit(level) >= cap)
        got = sources.agg(
            F.count(F.when(over, 1)).alias("n"),
            F.sum(F.when(over, F.col("source_size"))).alias("held"),
            F.sum(F.when(~over, F.col("w"))).alias("free"),
        ).first()
        if got["n"] == clamped or not got["free"]:
            break
        clamped = got["n"]
        level = (goal - float(max_epochs) * float(got["held"] or 0)) / got["free"]
    return sources.withColumn("target", F.least(cap, F.col("w") * F.lit(level)).cast("double"))


def plan_mix(sized: DataFrame, source: str = "source", size: str = "size", draw_col: str = "u",
             weights: Sequence[int] = (1, 2, 3), max_epochs: float = 3, share: float = 1.0) -> DataFrame:
    """One row per source: (source, source_size, w, target, whole, cut).

    ``cut`` is the draw up to and including which a document is taken once
    more; it is placed so that the extra words come as near as can be to the
    fraction asked for.  A histogram of draws narrows the place to one bucket
    per source; only that bucket's rows are then summed in order.
    """
    sources = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    # the source table is used again and again, so it is kept
    filled = stash(water_fill(stash(rank_weights(sources, "source", weights), "weights"), max_epochs, share), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + F.lit(1e-9))
    filled = filled.withColumn("whole", whole).withColumn(
        "need", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    rows = sized.select(F.col(source).alias("source"), F.col(size).alias("size"), F.col(draw_col).alias("u"))
    width = (1 << 48) // CUT_BUCKETS
    rows = rows.withColumn("b", F.floor(F.col("u") / F.lit(width)))
    w = Window.partitionBy("source").orderBy("b")
    bins = rows.groupBy("source", "b").agg(F.sum("size").alias("s")).withColumn("upto", F.sum("s").over(w))
    edge = small(filled.select("source", "need"), filled)
    at = bins.join(edge, bins["source"].eqNullSafe(edge["source"])).drop(edge["source"])
    # the first bucket at whose end the sum reaches the need
    at = at.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("s") < F.col("need")))
    at = at.groupBy("source").agg(F.min_by(F.struct("b", (F.col("upto") - F.col("s")).alias("start"), "need"), "b").alias("x")).select(
        F.col("source").alias("src"), F.col("x.b").alias("eb"), F.col("x.start"), "x.need")
    at = small(stash(at, "edges"), filled)
    inside = rows.join(at, rows["source"].eqNullSafe(at["src"]) & (rows["b"] == at["eb"]))
    sums = inside.groupBy("src", "u").agg(F.sum("size").alias("s"), F.first("need").alias("need"), F.first("start").alias("start"))
    by = Window.partitionBy("src").orderBy("u")
    sums = sums.withColumn("upto", F.col("start") + F.sum("s").over(by)).withColumn("prev", F.lag("u").over(by))
    # the document that crosses the need is taken if that comes nearer to it
    crossing = sums.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("s") < F.col("need")))
    below = F.coalesce(F.col("prev"), F.col("u") - 1)
    cut = crossing.select("src", F.when(F.col("upto") - F.col("need") <= F.col("need") - (F.col("upto") - F.col("s")), F.col("u")).otherwise(below).alias("cut"))
    out = filled.join(cut, filled["source"].eqNullSafe(cut["src"]), "left").drop("src", "need")
    return stash(out.withColumn("cut", F.coalesce("cut", F.lit(-1)).cast("long")).withColumn("whole", F.col("whole").cast("long")), "mix")


def small(df: DataFrame, sources: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if there are few sources; its size is checked."""
    return F.broadcast(df) if sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else df


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = (1, 2, 3), max_epochs: float = 3, share: float = 1.0, seed: int = 20) -> tuple[DataFrame, DataFrame]:
    """(sized, plan): the documents with ``size`` and ``u``, and the plan per source.

    Null texts have size 0.  Null sources form one source, the last.  Rows of
    equal key get equal draws.  Documents of size 0 may be taken or not; they
    add no words.  An empty table gives an empty plan.  Other columns of
    ``docs`` are not read, so their names may clash with anything here.
    """
    sized = stash(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                              draw(F.col(key), seed).alias("u")), "sized")
    return sized, plan_mix(sized, weights=weights, max_epochs=max_epochs, share=share)


def repeats(rows: DataFrame, plan: DataFrame, source: str = "source", draw_value: Column | None = None) -> DataFrame:
    """Adds ``_size``, ``_target``, ``_times`` to ``rows``: how often each is taken."""
    plan = small(plan.select(F.col("source").alias("_src"), F.col("source_size").alias("_size"), F.col("target").alias("_target"), "whole", "cut"), plan)
    u = F.col("u") if draw_value is None else draw_value
    out = rows.join(plan, rows[source].eqNullSafe(plan["_src"]))
    return out.withColumn("_times", F.col("whole") + F.when(u <= F.col("cut"), 1).otherwise(0)).drop("_src", "whole", "cut")


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 20, **how) -> DataFrame:
    """The mixed corpus itself: each row of ``docs`` as often as it is taken.

    Texts are not shuffled: the plan per source is joined to the rows where
    they are read, and each row is repeated in place.
    """
    _, plan = mix(docs, key, text, source, seed=seed, **how)
    names = docs.columns
    bare = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(source).alias("_source"), draw(F.col(key), seed).alias("_u"))
    out = repeats(bare, plan, "_source", F.col("_u"))
    out = out.where("_times > 0").select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_times").cast("int"))).alias("_n"))
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])
