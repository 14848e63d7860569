"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded random order; a row's fractional rank is its place in
that order divided by the size of its source.  Sorted by fractional rank, every stretch of rows
has the mixture of the whole, and the sequence is cut into shards of equal row counts.

Equal texts are a group.  A group that fits a shard is ranked as one: it stands in the source of
its rows that sorts first, all its rows have one fractional rank, and so they follow each other
and part only where a cut between shards falls among them.  A larger group has to be split
anyway; its rows are ranked one by one and spread like others.

No task sorts a source or the corpus: ranks are offsets of hash buckets (prefix sums over counts)
plus the place in a bucket; positions likewise over buckets of fractional rank.  The number of
both follows the number of rows.  Only narrow rows are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlytics.llm.common import pick, written

SHARDS, SEED = 40, 42
#: Rows of a bucket, about; a group that fits a shard may make one larger.
BUCKET_ROWS = 1 << 16


def _bucket(digest: str, buckets: int):
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % buckets).alias("b")


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null) per row of docs.

    Shards differ by at most one row and each has every source in its share, but for groups of
    equal texts that lie in one shard.  At most `shards` - 1 of the groups that fit a shard are
    split, each over two shards; null and empty text are one group.  Size is UTF-8 bytes plus 16;
    null text has no bytes.  A null source is a source.  Ties fall to the row's own hash, then
    doc_id, then text checksum; fully equal rows are interchangeable.  The order depends on `seed`
    and the rows only, not on partitions - except that rows equal in text and doc_id, if they are
    more than a shard and a bucket hold, are spread by where they lie.  Empty table: no rows.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    t = F.coalesce("text", F.lit(""))
    d = pick(docs, "doc_id", "text", "source")
    rows = written(d.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("n")).alias("src"),
        (F.octet_length(t) + 16).cast("long").alias("size"), F.crc32(F.encode(t, "UTF-8")).alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), t)).alias("h"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), t)).alias("h2")), "shard-rows")
    total = rows.count()
    fits, buckets = total // shards, max(1, total // bucket_rows)
    groups = (rows.groupBy("h").agg(F.count(F.lit(1)).alias("g"), F.min("src").alias("home"))
              .where(F.col("g").between(2, fits)))
    # rows equal in all but their place: fewer than `shards` such hashes
    same = (rows.groupBy("h2").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > max(fits, bucket_rows))
            .select("h2", F.lit(True).alias("many")))
    place = F.md5(F.concat("h2", F.monotonically_increasing_id().cast("string")))
    unit = F.when(F.col("home").isNotNull(), F.col("h")).when(F.col("many"), place).otherwise(F.col("h2"))
    units = rows.join(groups, "h", "left").join(F.broadcast(same), "h2", "left").select(
        "doc_id", F.coalesce("home", "src").alias("src"), "size", "text_crc32", "h2", unit.alias("u"), F.coalesce("g", F.lit(1)).alias("g"))
    units = written(units.withColumn("b", _bucket("u", buckets)), "shard-units")
    counts = units.groupBy("src", "b").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy("src").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("src", "b", F.coalesce(F.sum("c").over(upto), F.lit(0)).alias("before"),
                           F.sum("c").over(Window.partitionBy("src")).alias("n"))
    # rank, not row number: all rows of a unit have as many rows before them
    ahead_of_unit = F.rank().over(Window.partitionBy("src", "b").orderBy("u")) - 1
    ranked = units.withColumn("ahead", ahead_of_unit).join(starts, ["src", "b"])
    twice = 2 * (F.col("before") + F.col("ahead")) + F.col("g")      # fractional rank is twice / (2 n)
    ranked = written(ranked.select(
        "doc_id", "src", "size", "text_crc32", "h2", "u", (twice / (2 * F.col("n"))).alias("at"),
        F.floor(twice * buckets / (2 * F.col("n"))).cast("long").alias("r")), "shard-ranks")
    earlier = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)  # over one row a bucket
    stretch = ranked.groupBy("r").agg(F.count(F.lit(1)).alias("c"))
    stretch = stretch.select("r", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("first"))
    order = Window.partitionBy("r").orderBy("at", "src", "u", "h2", "doc_id", "text_crc32")
    placed = (ranked.withColumn("k", F.row_number().over(order) - 1).join(stretch, "r")
              .withColumn("pos", F.col("first") + F.col("k"))
              .withColumn("shard", F.expr(f"cast(pos * {shards} div {max(total, 1)} as int)")))
    begin = F.expr(f"(shard * {total} + {shards} - 1) div {shards}")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         (F.col("pos") - begin).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
