"""Session settings, shared-folder materialisation and checkpoint location."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators count on.
#  * joins keep Spark's rule that both sides are partitioned on all join keys: with a weaker rule a
#    join on (city, tile) would settle for partitions by city, and a large city for one task;
#  * AQE picks broadcasts from measured sizes and splits skewed join partitions.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # tile pairs and footprints are small rows that expand inside a task: keep many partitions
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # for the same reason a task gets 8 MB of a shuffle, not 64, and a shuffle has parts to choose from: what a task
    # holds then stays the same however large the input is
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    # stored tables of ids and doubles take several times their files' size as rows: without this a table of 10 MB of
    # Parquet is sent to the driver and on to all executors as some 100 MB
    "spark.sql.sources.fileCompressionFactor": "8.0",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    # a query's shuffle files go when it has ended, not when the driver happens to collect its garbage: else the disk holds
    # those of all stages of a session at once
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cellscape")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_local_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, else a scratch folder when local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        _local_folder.setdefault(app, tempfile.mkdtemp(prefix="cellscape-"))
    return _local_folder[app]


_open = threading.local()  # scopes of this thread, each a list of the folders stored in it


def _store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of any executor, and gives later joins real table sizes.  Inside ``scratch``
    the table is kept until the scope ends.
    """
    stored, path = _store(df, name)
    if scopes := getattr(_open, "scopes", None):
        scopes[-1].append(path)
    return stored


@contextmanager
def scratch(spark: SparkSession):
    """Delete at the end what this thread has stored inside by ``materialize``; nothing lazy may still read it then.

    Gives a function like ``materialize`` for what stays, which belongs to the scope around, if any.
    """
    scopes = _open.__dict__.setdefault("scopes", [])
    around = scopes[-1] if scopes else None
    scopes.append([])

    def keep(df: DataFrame, name: str) -> DataFrame:
        stored, path = _store(df, name)
        if around is not None:
            around.append(path)
        return stored

    try:
        yield keep
    finally:
        jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in scopes.pop():
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(settings).delete(folder, True)


_shared: dict[tuple[str, str], DataFrame] = {}
_building: dict[tuple[str, str], threading.Lock] = {}


def materialize_once(spark: SparkSession, key: str, build) -> DataFrame:
    """Materialise ``build()`` the first time ``key`` is asked for in this application.

    Threads may ask for one key at the same time: one builds it, the others wait.  Tables that ``build`` stores on its
    way are deleted when the result is stored.
    """
    slot = (spark.sparkContext.applicationId, key)
    with _building.setdefault(slot, threading.Lock()):
        if slot not in _shared:
            with scratch(spark):
                _shared[slot] = _store(build(), key.replace("/", "_").strip("_"))[0]
    return _shared[slot]
