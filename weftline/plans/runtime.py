"""Run-time helpers: shared folder, materialised tables, size-checked broadcasts."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Tables of at most so many bytes may be sent whole to every executor.
BROADCAST_BYTES = 32 << 20

_written: dict[str, list[str]] = {}
_local: dict[str, str] = {}


def setting(spark: SparkSession, key: str) -> str | None:
    """A session or start-up setting, None where it is unset."""
    value = spark.conf.get(key, None)
    return value if value else spark.sparkContext.getConf().get(key, None)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` names it.  Where that is unset, a local master (tests) uses a
    temporary folder of its own and a cluster uses the warehouse if that lies in a store; a
    cluster whose warehouse is a local folder raises, as no executor would see another's files.
    """
    base = setting(spark, "spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        warehouse = setting(spark, "spark.sql.warehouse.dir") or ""
        if ":/" not in warehouse or warehouse.startswith("file:"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        return warehouse.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="weftline-")
    return _local[app]


#: While this holds, Spark deletes the shuffle files of a write once the write has ended.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the files go when the session ends.

    This cuts the lineage: what follows reads files that outlive any executor, and a lost
    executor costs a re-read rather than a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/weftline/{name}-{uuid.uuid4().hex}"
    _at_exit(spark, path)
    return _write(df, path)


class Scratch:
    """Materialised tables of one job; those that aren't kept go when the job's block ends.

    A result that is still to be read may refer only to tables written with ``keep``, which
    stay until the session ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.base = f"{shared_folder(spark)}/weftline/job-{uuid.uuid4().hex}"
        self.count = 0

    def __enter__(self) -> Scratch:
        _at_exit(self.spark, self.base)
        return self

    def __exit__(self, *_: object) -> None:
        _delete(self.spark, self.base)
        _written[self.spark.sparkContext.applicationId].remove(self.base)

    def write(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        if keep:
            return materialize(df, name)
        self.count += 1
        return _write(df, f"{self.base}/{self.count:03d}-{name}")


def _at_exit(spark: SparkSession, path: str) -> None:
    if not _written:
        atexit.register(_clean, spark)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop, as the shared one may lie in any store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # at exit the JVM may be gone already
        for path in _written.pop(spark.sparkContext.applicationId, []):
            _delete(spark, path)


def bounded_broadcast(df: DataFrame, row_bytes: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its size stays below ``limit`` bytes.

    ``row_bytes`` is the size of a row: a number, or a column that is summed over the rows.
    Beyond the limit ``df`` comes back unhinted and the join shuffles.  ``df`` should be a
    materialised or otherwise cheap table, as it is read for this.
    """
    size = F.sum(row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes))
    return F.broadcast(df) if (df.agg(size.alias("size")).first()["size"] or 0) <= limit else df


def prefix_sums(counts: DataFrame, key: str, count: str = "count") -> DataFrame:
    """(key, ord, count, before): rows with their rank from 0 and the sum of all counts before, in the order of ``key``.

    Keys are unique.  They are range-partitioned; what a range needs to know of earlier ones is one
    row for each of these, so nothing is sorted in one task.
    """
    none = F.lit(0).cast("long")
    dealt = counts.select(key, count).repartitionByRange(key)
    dealt = materialize(dealt.withColumn("part", F.spark_partition_id()), "ranges")
    parts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("keys"), F.sum(count).alias("total"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = parts.select("part", *[F.coalesce(F.sum(c).over(earlier), none).alias(f"{c}_before") for c in ("keys", "total")])
    inside = W.partitionBy("part").orderBy(key)
    own = dealt.withColumns({
        "own": F.row_number().over(inside) - 1,
        "own_total": F.coalesce(F.sum(count).over(inside.rowsBetween(W.unboundedPreceding, -1)), none),
    })
    return own.join(base, "part").select(
        key, (F.col("own") + F.col("keys_before")).alias("ord"), count, (F.col("own_total") + F.col("total_before")).alias("before")
    )


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of an Arrow batch from which a few very long texts close it.
BATCH_BYTES = 32 << 20


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of at most ``rows`` rows and about ``BATCH_BYTES`` bytes, so a batch of very long texts stays small.

    Set for the session: plans read it when they run, which may be later than this.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        held = int(str(spark.conf.get(key)).rstrip("bB"))
        if not 0 < held <= most:
            spark.conf.set(key, most)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores where it has fewer files than there are cores.

    A file of one row group is one task, however long its rows take.  Tables of more files are
    read as they are, without a shuffle.  Select the columns first.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df._jdf.inputFiles()) < cores else df  # counted there, no path comes here
