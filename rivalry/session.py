"""Session set-up."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "rivalry", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on (UTC, AQE with skew joins)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Partitions per core of an exchange that wide rows are sorted after.
PARTS_PER_CORE = 16


def wide_parts(spark: SparkSession) -> int:
    """The partitions for rows that a task sorts whole: AQE merges partitions, but cuts none
    that a window reads, so a small ``spark.sql.shuffle.partitions`` would make them large. A
    multiple of that setting, so that a task writes few buckets."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = PARTS_PER_CORE * spark.sparkContext.defaultParallelism
    return usual * -(-wanted // usual)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, which goes when Python
    ends: on a cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        own = tempfile.mkdtemp(prefix="rivalry-checkpoint-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


#: Folders of the tables stored and not dropped yet.
_FOLDERS: list[str] = []


def scratch_path(spark: SparkSession) -> str:
    """A new folder name in the shared folder, for what :func:`drop_stored` deletes."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    _FOLDERS.append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, for results that several jobs read.

    A written table cuts the lineage like ``checkpoint`` does and survives lost executors, but
    later reads take only the columns they need, and Spark knows its size. It stays until
    :func:`drop_stored`.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Names of the bucketed tables among them, by folder.
_TABLES: dict[str, str] = {}


def forget_buckets(spark: SparkSession, path: str) -> None:
    """Take a bucketed table out of the catalog; its files stay."""
    if path in _TABLES:
        spark.sql(f"drop table if exists {_TABLES.pop(path)}")


def _delete(spark: SparkSession, path: str) -> None:
    forget_buckets(spark, path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def laid_out(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    clustered: bool = False,
    path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``df`` written to the shared folder, or to ``path``, in buckets of ``keys``, each sorted by keys and order.

    Windows, groupings and lookups by the keys that read the first table need no exchange. The
    second is the same table as plain files, whose reads Spark splits whatever the buckets hold;
    it is for tables with a key too large for a bucket. The one exchange by the keys is a rebalance,
    so AQE splits a key with too many rows over several files; ``clustered`` says that ``df``
    reads a table of this kind and needs none. Joins by the keys and more columns use the buckets
    too: the other side alone is shuffled. Both stay until :func:`drop_stored`, a given ``path``,
    which is overwritten, for good.
    """
    spark = df.sparkSession
    # by default a join of wide rows by (entity, time) would shuffle buckets of the entity again
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", False)
    if path:
        _delete(spark, path)
    else:
        path = scratch_path(spark)
    buckets = wide_parts(spark)
    name = f"laid_out_{uuid.uuid4().hex}"
    rows = df if clustered else df.hint("rebalance", *keys)
    writer = rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *order)
    writer.option("path", path).saveAsTable(name)
    _TABLES[path] = name
    return spark.table(name), spark.read.schema(df.schema).parquet(path)


def stored_so_far() -> int:
    """How many tables are stored, as a mark for :func:`drop_stored`."""
    return len(_FOLDERS)


def drop_stored(spark: SparkSession, first: int = 0, last: int | None = None) -> None:
    """Delete stored tables, once the results that read them are written or fetched.

    All, or those from number ``first`` up to ``last``, in the order in which they were stored.
    """
    for path in _FOLDERS[first:last]:
        _delete(spark, path)
    del _FOLDERS[first:last]
