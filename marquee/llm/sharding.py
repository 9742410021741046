"""Documents dealt into shards of near equal size by sampled splitters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import load
from marquee.sources.tables import materialize

SHARDS = 8
# Ranges that the sample cuts: many per shard, so that whole ranges make up even shards, and
# more for large inputs, so that a range stays small enough for one task.
RANGES = 1024
RANGE_BYTES = 256 << 20
# Drawn per range, on average. The sample is as large for any input of the same ranges.
DRAWN = 14
# A range of more than this many times its share is subdivided.
OVERFULL = 2

# Tables with a row per range, or a few, are broadcast up to so many ranges; larger ones are joined.
SMALL = 1 << 17

# A place on the line that ranges cut: 30 bits of the text's hash, then 23 of the row's own.
TEXT_CELLS, ROW_CELLS = 1 << 30, 1 << 23
LINE = float(TEXT_CELLS * ROW_CELLS)


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, size, checksum and place of every row, and ``uid``, a number of its own.

    Equal texts lie in one cell of the line. Rows of a cell are spread over it by a hash of
    doc_id and uid, so even a cell with most of all rows can be cut.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("hash"),
        F.monotonically_increasing_id().alias("uid"))
    cell = F.pmod(F.shiftright("hash", 8), F.lit(TEXT_CELLS))
    own = F.pmod(F.xxhash64("doc_id", "uid"), F.lit(ROW_CELLS))
    return rows.withColumn("place", (cell * ROW_CELLS + own).cast("double")).drop("hash")


def splitters(rows: DataFrame, total: int, ranges: int) -> DataFrame:
    """The ranges, ``number``, ``low`` and ``high``, of near equal bytes, from a sample drawn by size.

    A row is drawn as often as its size holds the sampling step; what is left over decides by
    the row's hash. So a large row may be drawn many times, and the sample's quantiles are
    those of the bytes. The sample is put in order by ranges of its own, and counted within them and by
    the counts of those before, so borders are found where they lie; the last window sees a row per
    range.
    """
    step = max(total / (ranges * DRAWN), 1.0)
    chance = F.pmod(F.xxhash64("uid", "place"), F.lit(1 << 20)) / float(1 << 20)
    drawn = rows.select("place", F.floor(F.col("size") / step + chance).alias("times")).filter("times > 0")
    dealt = materialize(drawn.repartitionByRange("place").withColumn("lot", F.spark_partition_id()), "sample")
    lots = dealt.groupBy("lot").agg(F.sum("times").alias("held"))
    marks = dealt.agg(F.sum("times").alias("n")).first().n or 0
    earlier = Window.orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.select("lot", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    so_far = F.sum("times").over(Window.partitionBy("lot").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) + F.col("before")
    counted = dealt.join(F.broadcast(lots), "lot").select("place", "times", so_far.alias("n"))
    share = max(marks / ranges, 1e-9)
    border = F.floor(F.col("n") / share) > F.floor((F.col("n") - F.col("times")) / share)
    lows = counted.filter(border & (F.col("place") > 0) & (F.col("n") < marks)).select(F.col("place").alias("low"))
    lows = lows.union(rows.sparkSession.range(1).select(F.lit(0.0).alias("low"))).distinct()
    line = Window.orderBy("low")
    return lows.select((F.row_number().over(line) - 1).alias("number"), "low",
                       F.lead("low", 1, LINE).over(line).alias("high"))


def numbered_ranges(rows: DataFrame, edges: DataFrame, ranges: int) -> DataFrame:
    """The rows with the range that their place lies in, its ``low`` and its ``high``.

    The line is also cut into as many cells of equal width, and each has the list of the ranges that
    reach into it, two on average. Rows meet the list of their cell.
    """
    width = LINE / ranges
    first, last = (F.floor(F.col(c) / width).cast("long") for c in ("low", "high"))
    reached = edges.withColumn("cell", F.explode(F.sequence(first, F.least(last, F.lit(ranges - 1)))))
    cells = materialize(reached.groupBy("cell").agg(
        F.collect_list(F.struct("number", "low", "high")).alias("near")), "cells")
    cell = F.least(F.floor(F.col("place") / width).cast("long"), F.lit(ranges - 1))
    found = rows.withColumn("cell", cell).join(F.broadcast(cells) if ranges <= SMALL else cells, "cell")
    own = F.filter("near", lambda r: (r.low <= F.col("place")) & (F.col("place") < r.high))[0]
    return found.withColumn("own", own).select(*rows.columns, "own.*")


def shard(documents: DataFrame, shards: int = SHARDS, ranges: int = RANGES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document.

    The law is ``bytes``: shards hold near equal sums of ``size``, the UTF-8 bytes of the text
    plus 1. Documents lie on a line by the hash of their text, and equal texts together. The
    line is cut into ranges by sampled splitters; all rows of each are counted, and a
    range with more than twice its share, as one row or text may bring about, is cut
    evenly again. Whole ranges in order make up the shards, so a shard is off by a range at most,
    and only texts at a border, or larger than a shard, are parted. Slots count a shard's rows
    from 0 in line order: those of earlier ranges, then those before it in its own.

    Null texts count as empty; null doc_ids and repeated rows are rows like others. An empty
    table gives an empty one. Which rows go together depends on the order of equal ones in the
    input files. No row is moved but by its range, and text not at all.
    """
    if shards < 1 or ranges < shards:
        raise ValueError("there must be a shard, and as many ranges as shards")
    rows = materialize(keyed(documents), "sizes")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    ranges = max(ranges, -(-total // RANGE_BYTES))
    edges = materialize(splitters(rows, total, ranges), "edges")
    ranged = numbered_ranges(rows, edges, ranges)

    fair = max(total / ranges, 1.0)
    sizes = ranged.groupBy("number").agg(F.sum("size").alias("bytes"))
    plan = materialize(sizes.select("number", F.when(
        F.col("bytes") > OVERFULL * fair, F.ceil(F.col("bytes") / fair)).otherwise(1).alias("parts")), "ranges")
    part = F.least(F.floor((F.col("place") - F.col("low")) * F.col("parts") / (F.col("high") - F.col("low"))),
                   F.col("parts") - 1).cast("int")
    few = F.broadcast if ranges <= SMALL else lambda table: table
    parted = ranged.join(few(plan), "number").withColumn("part", part).drop("low", "high", "parts")

    held = materialize(parted.groupBy("number", "part").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows")), "parts")
    line = Window.orderBy("number", "part")
    before = F.sum("bytes").over(line) - F.col("bytes")
    chosen = F.least(F.floor((before + F.col("bytes") / 2) * shards / F.lit(max(total, 1))), F.lit(shards - 1))
    within = Window.partitionBy("shard").orderBy("number", "part")
    layout = (held.withColumn("shard", chosen.cast("int"))
              .withColumn("base", F.sum("rows").over(within) - F.col("rows"))
              .select("number", "part", "shard", "base"))
    # at most OVERFULL parts per range on average
    placed = parted.join(few(layout), ["number", "part"])
    order = Window.partitionBy("number", "part").orderBy("place", "doc_id", "uid")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.row_number().over(order) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(load(spark, sf_dir, "documents"))
