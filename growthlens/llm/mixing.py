"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlens.llm.common import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
# No document is taken more than this often, so no source beyond this multiple of its size.
MOST = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target and rate of each source from (source, source_size).

    Sources take the weights in turn, by code point with null last, and share
    all words by them.  A source whose share passes ``most`` times its size
    stops there and its excess goes to the others by weight until none is
    above: sorted by size per weight, the sources that stop are a prefix, and
    the first prefix behind which the common level fits the next source is it.
    The table has a row per source, so its windows are small.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(turn, F.lit(len(weights))) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ).cast("double") / F.sum("weight").over(after)
    stops = F.col("level") * F.col("weight") > F.lit(most) * F.col("source_size")
    table = sizes.withColumn("weight", weight.cast("long")).withColumn("level", level)
    # the level that holds is that of the first source that does not stop
    table = table.withColumn("place", F.row_number().over(order))
    held = F.min(F.when(~stops, F.struct("place", "level"))).over(everything)["level"]
    table = table.withColumn("held", held)
    cap = (F.lit(most) * F.col("source_size")).cast("double")
    target = F.least(F.coalesce(F.col("held") * F.col("weight"), cap), cap)
    return table.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def source_offset(source: Column, seed: str = SEED) -> Column:
    """The random offset of a source, from 0 to 1, drawn from ``seed``."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.concat(F.lit("="), source), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
    key: Column | None = None,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every row of ``docs``.

    Within a source each document is expected ``rate`` = target / source_size
    times.  In the order of size and id these expectations are summed up, one
    random offset is added, and a document is emitted once for each integer its
    stretch crosses; with neighbours alike in size, a source's taken words differ
    from its target by its longest document at most.

    The sums run over all documents of a source without gathering it: the
    (source, size, id) rows are sorted by range and stored, numbered within
    their partition, and the partitions' counts, a few rows each, are summed.

    Null and blank texts have size 0 and are taken like the others, with no
    words; a null source is a source of its own; rows with equal ids count
    each; null ids come first; an empty table gives no rows; other columns are
    not read.  ``key``, a stored value that no two rows share, comes last in the
    order and is returned as ``key``, so that each row finds its own copies.
    """
    named = [] if key is None else ["key"]
    narrow = cut_lineage(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *([] if key is None else [key.alias("key")]))
    )
    keys = [F.col("source").asc_nulls_last(), F.col("size").asc(), F.col("doc_id").asc_nulls_first(), *named]
    ranged = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = cut_lineage(ranged.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).alias("part")
    parts = ranged.groupBy("source", part).agg(
        F.count("*").alias("n"), F.min("at").alias("first"), F.sum("size").alias("words")
    )
    parts = cut_lineage(parts)
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("first"))
    sizes = parts.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "of")
    plan = parts.join(targets, parts["source"].eqNullSafe(targets["of"])).select(
        F.col("source").alias("of"), "part", "ahead", "source_size", "target", "rate",
        source_offset(F.col("source"), seed).alias("draw"),
    )
    rows = ranged.withColumn("in_part", part).join(
        plan, (F.col("in_part") == F.col("part")) & F.col("source").eqNullSafe(F.col("of"))
    )
    place = F.col("at") + F.col("ahead")
    copies = F.floor(F.col("draw") + F.col("rate") * (place + 1)) - F.floor(F.col("draw") + F.col("rate") * place)
    copies = copies.cast("long")
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *named
    )
