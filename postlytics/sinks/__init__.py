"""Sinks: JSON/Parquet writes, key-idempotent appends and state tables.

Appends are idempotent on the key: rows whose key the target holds are dropped first
(only keys are read), what is left is reduced to one row per key and appended.
Re-running a batch appends nothing, and reads no text.  Texts are written by the tasks that read
them; only days in which stored and new keys mix are joined row by row.  The key alone decides: an id that
comes again with other fields, its date included, is still the same post.  So that a lookup does
not read all history, tables are clustered by blocks of ids beside their own partitions: ids of
posts rise with time, a batch touches few blocks, and the folders of all others are pruned.
A row without a key has no identity to be idempotent on: it goes to the quarantine table, where
whole rows are compared.  An empty batch is a no-op, also as the first one.  One writer per table
is assumed (plain Parquet has no transactions); the data is written before any state that points
past it, and what is replaced as a whole is written beside and then swapped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlytics import config as C
from postlytics.operators.state import dedupe_latest, latest_per_key
from postlytics.session import open_writers, scratch_path, shuffles_dropped


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move_folder(spark: SparkSession, path: str, target: str) -> str:
    """The folder at `path` moved to `target`, which must not exist; without one there, an empty `target`."""
    fs, to = _fs(spark, target)
    if fs.exists(to):
        raise FileExistsError(target)
    fs.mkdirs(to.getParent())
    if not _exists(spark, path):
        fs.mkdirs(to)
    elif not fs.rename(_fs(spark, path)[1], to):
        raise OSError(f"{path} could not be moved to {target}")
    return target


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written once as Parquet in the shared scratch folder and read again, and its path: what
    follows reads columns instead of parsing the source each time."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def recover(spark: SparkSession, path: str) -> str:
    """Finish a replacement of `path` that a crash cut off: a complete new version beside it takes
    its place, an incomplete one goes.  Returns the path."""
    new = path.rstrip("/") + "_next"
    if _exists(spark, new):
        if _exists(spark, new + "/_SUCCESS"):
            _remove(spark, path)
            fs, p = _fs(spark, new)
            fs.rename(p, _fs(spark, path)[1])
        else:
            _remove(spark, new)
    return path


def replace(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """The table at `path` replaced as a whole, also by rows that are read from it.

    The new version is complete before the old one goes; at no point is there neither (see
    `recover`, which every later replacement and `read_state` call first).
    """
    recover(df.sparkSession, path)
    df.write.mode("overwrite").format(fmt).save(path.rstrip("/") + "_next")
    return recover(df.sparkSession, path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> str:
    """Records as JSON lines, written once."""
    df.write.mode(mode).json(path)
    return path


def _stored(spark: SparkSession, target: str, like: DataFrame) -> DataFrame | None:
    """The table at `target` with the batch's schema (so a folder without data files is an empty
    table), or None if there is no folder."""
    return spark.read.schema(like.schema).parquet(target) if _exists(spark, target) else None


BLOCK = "id_block"


def id_block(key: str | Column) -> Column:
    """The block of ids that a key lies in (C.ID_BLOCK_BITS low bits cut off); null if it is no number."""
    return F.shiftright((F.col(key) if isinstance(key, str) else key).try_cast("bigint"), C.ID_BLOCK_BITS)


def touched(batch: DataFrame, target: str, key: str = "tweet_id", like: DataFrame | None = None) -> DataFrame | None:
    """The stored rows of the blocks that the batch touches, with the columns of the batch (or of
    `like`); None without a table.

    The batch's blocks are found first, so the folders of all other blocks are pruned as the
    scan is planned: by name if the batch has up to C.ID_BLOCKS_NAMED, else by their range.
    """
    stored = _stored(batch.sparkSession, target, batch if like is None else like)
    if stored is None:
        return None
    if BLOCK in stored.columns:
        blocks = batch.where(F.col(key).isNotNull()).select(id_block(key).alias("b"))
        named = [r.b for r in blocks.distinct().limit(C.ID_BLOCKS_NAMED + 1).collect()]
        if len(named) <= C.ID_BLOCKS_NAMED:
            touched = F.col(BLOCK).isin([b for b in named if b is not None])
        else:
            touched = F.col(BLOCK).between(*blocks.agg(F.min("b"), F.max("b")).first())
        stored = stored.where(touched | F.col(BLOCK).isNull() if None in named else touched)
    return stored


def known_keys(batch: DataFrame, target: str, key: str = "tweet_id") -> DataFrame | None:
    """(_key): the stored keys of the blocks that the batch touches (see `touched`), None without a table."""
    stored = touched(batch, target, key)
    return None if stored is None else stored.select(F.col(key).alias("_key"))


def new_rows(batch: DataFrame, target: str, key: str = "tweet_id",
             order_col: str | None = None, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The rows of `batch` with a key that is not in the Parquet table `target` yet, in whatever
    partition it may lie there (`partition_by` says how the table is laid out and decides nothing).

    Duplicates inside the batch keep the copy with the largest `order_col` (or any
    one copy when None, via max of the row).
    """
    batch = batch.where(F.col(key).isNotNull())
    loaded = known_keys(batch, target, key)
    if loaded is not None:
        batch = batch.join(loaded, batch[key] == loaded["_key"], "left_anti")
    return _one_per_key(batch, key, order_col)


def beside(keys: DataFrame, n: int) -> DataFrame:
    """A table of `n` rows (at most) to join with: it goes to every task if it has up to
    C.BROADCAST_ROWS rows; a larger one is shuffled, however small its compressed files look."""
    return F.broadcast(keys) if n <= C.BROADCAST_ROWS else keys.hint("merge")


def _one_per_key(rows: DataFrame, key: str, order_col: str | None) -> DataFrame:
    if order_col is None:
        return dedupe_latest(rows.withColumn("_one", F.lit(0)), key, "_one").drop("_one")
    return dedupe_latest(rows, key, order_col)


def fresh_rows(batch: DataFrame, target: str, key: str = "tweet_id", order_col: str | None = None,
               grain: tuple[str, ...] = ()) -> tuple[DataFrame, int, int]:
    """The rows of `new_rows`, how many the batch holds of them (copies counted), and its rows without a key.

    A first pass reads the key and the `grain` columns alone and finds, for each value of the grain
    (a day, say), whether rows there have a stored key, or one that the batch holds twice.  Where
    none has, rows are taken where they lie; where all are stored, none is read again; only in the
    others are rows joined by key, with the new keys of these days.  So overlapping pulls shuffle at
    most the texts of mixed days, and none if few keys there are new.
    The batch is evaluated twice and must give the same rows each time, as files do.
    """
    # the grain as text, so that a choice of values is a plain condition that reaches the scan
    value = F.to_json(F.struct(*grain)) if grain else F.lit("")
    keys, _ = staged(batch.select(key, value.alias("_value")), "append-keys")
    places = keys.groupBy(F.col(key).alias("_key"), "_value").agg(F.count(F.lit(1)).alias("n"))
    found = places.groupBy("_key").agg(F.sum("n").alias("n"), F.collect_list(F.struct("_value", "n")).alias("at"))
    loaded = known_keys(keys, target, key)
    if loaded is None:
        found = found.withColumn("stored", F.lit(False))
    else:
        found = (found.join(loaded.distinct().withColumn("stored", F.lit(True)).hint("merge"), "_key", "left")
                 .withColumn("stored", F.coalesce("stored", F.lit(False))))
    found, _ = staged(found, "append-found")
    fresh = F.col("_key").isNotNull() & ~F.col("stored")
    count = lambda cond: F.sum(F.when(cond, F.col("at.n")).otherwise(0))
    fates = found.withColumn("at", F.explode("at")).groupBy(F.col("at._value").alias("value")).agg(
        count(F.col("_key").isNull()).alias("keyless"), count(F.col("stored")).alias("stored"),
        count(fresh & (F.col("n") > 1)).alias("doubled"), count(fresh).alias("fresh")).collect()
    live = [r for r in fates if r.fresh]
    whole = [r.value for r in live if not r.stored and not r.doubled]
    mixed = [r.value for r in live if r.stored or r.doubled]
    n_mixed = sum(r.fresh for r in live if r.value in mixed)
    n_fresh, n_keyless = sum(r.fresh for r in live), sum(r.keyless for r in fates)
    rows = batch.where(F.col(key).isNotNull())
    if len(whole) == len(fates):
        return rows, n_fresh, n_keyless
    rest, rows = rows.where(value.isin(mixed)), rows.where(value.isin(whole))
    if mixed:
        # the new keys of these days alone: few beside the rows there, if most are stored
        here = F.exists("at", lambda a: a["_value"].isin(mixed))
        wanted = found.where(fresh & here).select(F.col("_key").alias("_fresh_key"), "n")
        of = lambda cond: rest.join(beside(wanted.where(cond), n_mixed), rest[key] == F.col("_fresh_key"), "left_semi")
        rows = rows.unionByName(of("n = 1"))
        if any(r.doubled for r in live):
            rows = rows.unionByName(_one_per_key(of("n > 1"), key, order_col))
    return rows, n_fresh, n_keyless


def append_new(batch: DataFrame, target: str, key: str = "tweet_id",
               order_col: str | None = None, partition_by: tuple[str, ...] = (),
               quarantine: str | None = None, grain: tuple[str, ...] = ()) -> None:
    """Append the rows of `batch` whose key is not stored yet (see `fresh_rows`; `grain` is by
    default what the table is partitioned by); rows without a key go to `quarantine` (by default
    beside the target), each distinct row once."""
    rows, n, keyless = fresh_rows(batch, target, key, order_col, grain or partition_by)
    append_rows(rows, target, key, partition_by, n)
    without = batch.where(F.col(key).isNull() if keyless else F.lit(False))
    quarantine_rows(without, quarantine or target.rstrip("/") + "_no_key")


def append_rows(rows: DataFrame, target: str, key: str = "tweet_id", partition_by: tuple[str, ...] = (),
                n: int | None = None) -> None:
    """Append rows as they are, laid out by `partition_by` and then by block of ids.

    More than C.FEW_ROWS rows (`n`, if it is known) are written by the tasks that hold them.
    """
    layout = [*partition_by, BLOCK]
    rows = rows.withColumn(BLOCK, id_block(key))
    if n is None or n <= C.FEW_ROWS:
        # few files per partition value; AQE splits a partition value that is hot
        rows = rows.hint("rebalance", *layout)
    with open_writers(rows.sparkSession, C.OPEN_WRITERS), shuffles_dropped(rows.sparkSession):
        rows.write.mode("append").partitionBy(*layout).parquet(target, compression="zstd")


def partition_values(spark: SparkSession, path: str, columns: tuple[str, ...]) -> list[tuple]:
    """The values (text, None for null) of the first partition columns that `path` has folders of; a listing."""
    fs, p = _fs(spark, path)
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(  # noqa: SLF001
        p, "/".join(f"{c}=*" for c in columns)))
    out = []
    for status in found or ():
        parts = status.getPath().toString().rstrip("/").split("/")[-len(columns):]
        values = tuple(x.split("=", 1)[1] for x in parts)
        out.append(tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values))
    return out


def quarantine_rows(rows: DataFrame, path: str) -> None:
    """Append each row (as JSON text, with its digest) that the quarantine does not hold yet."""
    spark = rows.sparkSession
    kept = rows.select(F.to_json(F.struct(*rows.columns)).alias("row")).withColumn("digest", F.sha2("row", 256))
    kept = kept.dropDuplicates(["digest"])
    stored = _stored(spark, path, kept)
    if stored is not None:
        kept = kept.join(stored.select("digest"), "digest", "left_anti")
    kept.write.mode("append").parquet(path)


RAW_PARTITIONS = ("post_date",)


def post_date(created_at: str = "created_at"):
    """The UTC date of a post, null where `created_at` is not an epoch-ms number."""
    ms = F.col(created_at).try_cast("bigint")
    return F.date_from_unix_date(F.floor(ms / 86_400_000).cast("int"))


def append_raw(batch: DataFrame, target: str, key: str = "tweet_id") -> None:
    """Key-idempotent append to the raw table, partitioned by post date."""
    append_new(batch.withColumn("post_date", post_date()), target, key, partition_by=RAW_PARTITIONS)


def read_table(spark: SparkSession, path: str, id_cols: tuple[str, ...] = ("author_id",)) -> DataFrame:
    """Read a stored table; id columns discovered from partition folders come back as Long."""
    df = spark.read.parquet(path).drop(BLOCK)
    for c in id_cols:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("bigint"))
    return df


def overwrite_state(state: DataFrame, path: str) -> str:
    """One row per key, replaced as a whole (the per-author state object)."""
    return replace(state, path)


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The state table at `path`; empty if there is none yet."""
    if not _exists(spark, recover(spark, path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def write_state_objects(state: DataFrame, path: str) -> str:
    """One JSON object per row (`to_json` of the row), the whole state replaced."""
    return replace(state.select(F.to_json(F.struct(*state.columns)).alias("value")), path, "text")


def read_state_objects(spark: SparkSession, path: str, schema) -> DataFrame:
    """The state objects back as typed columns (`from_json` with an explicit schema)."""
    return spark.read.text(recover(spark, path)).select(F.from_json("value", schema).alias("s")).select("s.*")


def append_log(rows: DataFrame, path: str, once_by: tuple[str, ...] = ()) -> str:
    """Append log rows; with `once_by` those that the log does not hold yet by these columns
    (nulls compare as equal), so a replay writes no second row."""
    if once_by and _exists(rows.sparkSession, path):
        held = rows.sparkSession.read.schema(rows.schema).parquet(path).select(*[F.col(c).alias(f"_{c}") for c in once_by])
        rows = rows.join(held, [rows[c].eqNullSafe(held[f"_{c}"]) for c in once_by], "left_anti")
    rows.write.mode("append").parquet(path)
    return path


def read_latest_log(spark: SparkSession, path: str, key: str, order_col: str,
                    value_cols: list[str]) -> DataFrame:
    return latest_per_key(spark.read.parquet(path), key, order_col, value_cols)


def touch_empty(spark: SparkSession, path: str) -> str:
    """Create a zero-byte file (used to land an empty pull)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    fs.create(p, False).close()
    return path
