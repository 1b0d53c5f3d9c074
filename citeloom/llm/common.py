"""Shared helpers of the training-data operators: staged tables, joins with heavy keys, word pattern."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"

_LOCAL_DIR: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a temporary folder is used, but only under a ``local`` master, where one
    machine runs everything; on a cluster the setting is required.
    """
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL_DIR or not os.path.isdir(_LOCAL_DIR[0]):
        _LOCAL_DIR[:] = [tempfile.mkdtemp(prefix="citeloom-")]
    return "file://" + _LOCAL_DIR[0]


def stage_root(spark: SparkSession) -> str:
    """Folder of this application's staged tables."""
    return f"{shared_dir(spark)}/citeloom-stage/{spark.sparkContext.applicationId}"


def clear_stages(spark: SparkSession) -> None:
    """Delete all staged tables of this application; results that still read them must be written first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Lists that take the paths of tables staged while they are open (see ``recorded``).
_RECORDS: list[list[str]] = []
#: Spark's setting by which a query's shuffle files are deleted when it has ended.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors.

    Row numbers made by ``monotonically_increasing_id`` become stable once staged. Shuffle files of
    the write are deleted when it has ended, so disks hold those of one staged table at a time.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    for record in _RECORDS:
        record.append(path)
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def recorded() -> Iterator[list[str]]:
    """A list of the paths of all tables staged inside the block."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not paths]


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(*tables: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for df in tables:
        drop_paths(df.sparkSession, sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}))


#: Rows and bytes of an Arrow batch that goes to a Python worker: documents may be long.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for this session, unless it has settings of its own: at Spark's defaults
    a batch holds 10,000 documents or 64 MB, in the executor as well as in its Python worker."""
    for key, usual, wanted in (("maxRecordsPerBatch", "10000", str(BATCH_ROWS)), ("maxBytesPerBatch", f"{64 << 20}b", f"{BATCH_BYTES}b")):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}") == usual:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", wanted)


#: Bits of the map of heavy keys, rows from which a key counts as heavy, and tasks that such a key is dealt to.
HEAVY_BITS, HEAVY_ROWS, SALTS = 20, 20_000, 32


def bits_of(keys: DataFrame, *columns: str, bits: int) -> DataFrame:
    """A bitmap of fixed size over the hashes of some keys: rows (word, bits) of 64 bits each."""
    cell = F.pmod(F.xxhash64(*columns), F.lit(1 << bits))
    cells = keys.select((cell / 64).cast("int").alias("word"), (cell % 64).cast("int").alias("at"))
    return cells.groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))).alias("bits"))


def with_bit(df: DataFrame, bitmap: DataFrame, *columns: str, bits: int, out: str) -> DataFrame:
    """``out``: whether the bitmap, broadcast, has the bit of each row's key. Wrong hits are possible, misses aren't."""
    cell = F.pmod(F.xxhash64(*columns), F.lit(1 << bits))
    there = bitmap.select(F.col("word").alias("word__"), F.col("bits").alias("bits__"))
    joined = df.join(F.broadcast(there), (cell / 64).cast("int") == F.col("word__"), "left")
    return joined.withColumn(out, F.coalesce(F.getbit("bits__", (cell % 64).cast("int")) == 1, F.lit(False))).drop("word__", "bits__")


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, row_key: str) -> DataFrame:
    """Inner join of rows with the one row of their group, where a group may hold a third of all rows.

    ``groups`` is a staged table with the number of rows of each in ``size``. Groups above
    ``HEAVY_ROWS`` are marked in a bitmap of fixed size; their rows are dealt to ``SALTS`` tasks by
    the hash of ``row_key``, and the group's row is sent to each of these.
    """
    heavy = bits_of(groups.filter(F.col(size) > HEAVY_ROWS), *on, bits=HEAVY_BITS)
    left = with_bit(rows, heavy, *on, bits=HEAVY_BITS, out="heavy__")
    left = left.withColumn("salt__", F.when(F.col("heavy__"), F.pmod(F.xxhash64(row_key), F.lit(SALTS)).cast("int")).otherwise(0)).drop("heavy__")
    right = with_bit(groups, heavy, *on, bits=HEAVY_BITS, out="heavy__")
    right = right.withColumn("salt__", F.explode(F.sequence(F.lit(0), F.when(F.col("heavy__"), SALTS - 1).otherwise(0)))).drop("heavy__")
    return left.join(right, [*on, "salt__"]).drop("salt__")


def row_ids(df: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of ``df`` with a unique row number ``rid``; stage the result before using it twice."""
    return df.select(F.monotonically_increasing_id().alias("rid"), *columns)


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts 0.

    Every start of a word is a word character at the beginning or after white space.
    """
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
