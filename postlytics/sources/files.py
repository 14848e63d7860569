"""Landed JSON files: layout, listing, incremental and latest-batch reads.

Layout: `<root>/batch=<b>/author_bucket=<k>/part-*.json.gz` (JSON lines, `author_id` inside; plain
`.json` files are read as well).  The
number of folders depends on the pulls alone, not on how many authors there are.  An author
filter prunes to one bucket and then compares the id itself (author 1 never matches author 12);
a batch is one pull.  Also read are folders `author_id=<a>` and plain files
`id_<author>_<time>.json` that hold an array of records.  File facts come from Spark's
`_metadata` column or from a `binaryFile` listing (content never read), never from a
driver-side loop over objects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from postlytics import config as C
from postlytics import sinks
from postlytics.schema import POST_SCHEMA
from postlytics.session import open_writers, shuffles_dropped

LANDED = "*.{json,json.gz}"
FILE_COLUMNS = ["_file_path", "_file_mtime", "_file_size"]
CORRUPT = "_corrupt_record"


def plain_path(path: Column) -> Column:
    """A path as `binaryFile` writes it: `_metadata` percent-encodes blanks and other characters."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def author_bucket(author: Column) -> Column:
    """The landing bucket of an author."""
    return F.pmod(F.xxhash64(author.cast("bigint")), F.lit(C.LANDING_AUTHOR_BUCKETS)).cast("int")


def land_json(df: DataFrame, root: str, batch) -> str:
    """Write one pull as JSON lines under `<root>/batch=<batch>/` (fails if it exists).

    Texts are written once and compressed, and not shuffled: each task writes its rows' buckets,
    C.LANDING_AUTHOR_BUCKETS files, or more if one would hold over C.LANDING_FILE_ROWS rows.  Only a pull of up to C.FEW_ROWS rows (counted by a
    look at the ids) is brought together first, so that it does not land in many tiny files.
    """
    path = f"{root.rstrip('/')}/batch={batch}"
    _write_landed(df.withColumn("author_bucket", author_bucket(F.col("author_id"))), path, "author_bucket")
    return path


def _write_landed(df: DataFrame, path: str, folder: str) -> None:
    if df.select(folder).count() <= C.FEW_ROWS:
        df = df.hint("rebalance", folder)
    with open_writers(df.sparkSession, C.OPEN_WRITERS), shuffles_dropped(df.sparkSession):
        (df.write.mode("error").option("maxRecordsPerFile", C.LANDING_FILE_ROWS)
         .option("zlib.compress.level", C.LANDING_GZIP_LEVEL).partitionBy(folder).json(path, compression="gzip"))


def write_pulls(df: DataFrame, batches: Column, path: str) -> str:
    """The rows of several pulls written in one pass as `<path>/batch=<b>/`, from where `land_pull`
    lands one pull at a time.  `batches`: an array of the pulls that a row comes in.

    There are no author buckets (an author filter compares the ids themselves), as each task would
    write its rows into the buckets of every pull, in files of few rows.
    """
    _write_landed(df.select("*", F.explode(batches).alias("batch")), path, "batch")
    return path


def land_pull(spark: SparkSession, written: str, root: str, batch: int) -> str:
    """Land one pull of `write_pulls` under `<root>/batch=<batch>/` (fails if it exists): its files
    are moved there.  A pull without rows lands as an empty folder."""
    name = f"batch={batch}"
    return sinks.move_folder(spark, f"{written.rstrip('/')}/{name}", f"{root.rstrip('/')}/{name}")


def _of_author(df: DataFrame, author) -> DataFrame:
    """Rows or files of one author: its folder or bucket, and its id where there is one."""
    if author is None:
        return df
    if "author_bucket" in df.columns:
        df = df.where(F.col("author_bucket") == author_bucket(F.lit(author)))
    return df.where(F.col("author_id") == F.lit(author)) if "author_id" in df.columns else df


def list_files(spark: SparkSession, root: str, glob: str = LANDED) -> DataFrame:
    """path, mtime, size and the partition columns of every landed file (content not read)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root)
             .drop("content"))
    files = files.withColumnRenamed("path", "_file_path") \
        .withColumnRenamed("modificationTime", "_file_mtime").withColumnRenamed("length", "_file_size")
    if "author_id" in files.columns:
        files = files.withColumn("author_id", F.col("author_id").cast("bigint"))
    return files


def read_landed(spark: SparkSession, root: str, schema: StructType = POST_SCHEMA,
                author=None, modified_after=None, processed_files: DataFrame | None = None,
                multi_line: bool = False, corrupt: bool = False, glob: str = LANDED,
                after_batch: int | None = None) -> DataFrame:
    """Rows of landed files with their file facts.

    * `after_batch`: only pulls with a larger number.  Their folders are found by one listing of
      the root, and no file of an older pull is listed or opened, so a run costs what is new.

    * `author`: exact author id (partition pruning, then the id itself).
    * `modified_after`: keep files modified strictly after this instant (compared with
      full precision, the marker fixed for the whole read).
    * `processed_files`: a table of `_file_path` already processed; those are skipped
      (what a file-stream checkpoint remembers).  Files older than the oldest
      unprocessed file are pruned before they are opened.
    * `multi_line`: files are JSON arrays or documents over several lines.
    * `corrupt`: add the text of records that are not valid JSON as `_corrupt_record`.
    Files of size 0 contribute nothing.
    """
    data_schema = schema
    if corrupt:
        data_schema = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    reader = (spark.read.schema(data_schema).option("multiLine", multi_line)
              .option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", glob))
    if after_batch is None:
        df = reader.json(root)
    else:
        later = pulls_after(spark, root, after_batch)
        # without a new pull: no rows, of the same columns as with one
        df = reader.option("basePath", root).json(later) if later else reader.json(root).limit(0)
    df = df.select("*",
                   plain_path(F.col("_metadata.file_path")).alias("_file_path"),
                   F.col("_metadata.file_modification_time").alias("_file_mtime"),
                   F.col("_metadata.file_size").alias("_file_size"))
    df = _of_author(df, author).drop("author_bucket").where(F.col("_file_size") > 0)
    if modified_after is not None:
        df = df.where(F.col("_file_mtime") > F.lit(modified_after).cast("timestamp"))
    if processed_files is not None:
        done = processed_files.select("_file_path").distinct()
        # bound the scan: files older than the oldest unprocessed one are pruned before
        # they are opened (the listing reads no content; one scalar comes back)
        listing = _of_author(list_files(spark, root, glob), author)
        oldest_new = listing.join(done, "_file_path", "left_anti").select(F.min("_file_mtime")).scalar()
        df = df.where(F.col("_file_mtime") >= oldest_new).join(done, "_file_path", "left_anti")
    return df


def pulls_after(spark: SparkSession, root: str, batch: int) -> list[str]:
    """The folders of the pulls numbered above `batch`."""
    numbers = sorted(int(b) for (b,) in sinks.partition_values(spark, root, ("batch",)) if b is not None and int(b) > batch)
    return [f"{root.rstrip('/')}/batch={b}" for b in numbers]


def read_versions(spark: SparkSession, root: str, schema: StructType = POST_SCHEMA, glob: str = LANDED) -> DataFrame:
    """Rows of landed files of any version of their schema: the columns of `schema`, `batch`, and
    `other_fields`, a VARIANT object of all fields that the schema does not know (empty if none).

    A field that a version lacks, or that does not fit the column's type, is null.  Records that
    are not JSON objects are all null; files of size 0 contribute nothing.
    """
    raw = spark.read.option("pathGlobFilter", glob).option("singleVariantColumn", "v").json(root)
    fields = F.try_variant_get("v", "$", "map<string,variant>")
    known = [f.name for f in schema.fields]
    return raw.select(
        *[F.try_variant_get("v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields],
        F.to_variant_object(F.map_filter(F.coalesce(fields, F.create_map().cast("map<string,variant>")),
                                         lambda k, _: ~k.isin(known))).alias("other_fields"),
        "batch")


def read_json_direct(spark: SparkSession, path: str) -> DataFrame:
    """Plain `read.json` with schema inference (one extra pass over the files)."""
    return spark.read.option("pathGlobFilter", LANDED).json(path)


def read_author_files(spark: SparkSession, root: str, author=None, **kw) -> DataFrame:
    """Rows of files `id_<author>_<time>.json`, each an array of records with `author_id` inside;
    further arguments as for `read_landed`."""
    glob = "id_*_*.json" if author is None else f"id_{author}_*.json"
    return read_landed(spark, root, author=author, glob=glob, **{"multi_line": True, **kw})


def author_files(spark: SparkSession, root: str, author=None) -> DataFrame:
    """author_id, batch and the facts of every file that holds rows of the author (only the id is parsed)."""
    rows = read_landed(spark, root, author=author)
    return rows.select("author_id", "batch", *FILE_COLUMNS).distinct()


def newest_file_time(files: DataFrame, key: str = "author_id") -> DataFrame:
    """Per key: the newest file time and the batch it belongs to."""
    best = F.max(F.struct("_file_mtime", "batch"))
    return files.groupBy(key).agg(best.alias("_b")).select(
        key, F.col("_b._file_mtime").alias("newest_file_time"), F.col("_b.batch").alias("newest_batch"))


def latest_batch_rows(spark: SparkSession, root: str, schema: StructType = POST_SCHEMA,
                      author=None) -> DataFrame:
    """For each author, all rows of its newest pull (the batch of its newest file)."""
    newest = newest_file_time(author_files(spark, root, author)).select(
        "author_id", F.col("newest_batch").alias("batch"))
    rows = read_landed(spark, root, schema, author=author)
    return rows.join(newest, ["author_id", "batch"], "left_semi")
