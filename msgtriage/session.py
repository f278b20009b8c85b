"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this package wants; callers can override any.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(
    master: str | None = None,
    app_name: str = "msgtriage",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers started from here on import the package from the driver's folder, where they
    see it (a local run, a shared installation); elsewhere ship the package with ``--py-files``."""
    import os
    from pathlib import Path

    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read here;
    running there without it is an error (a machine-local folder would not
    survive the loss of that machine). Where it is unset in local mode (local
    runs, tests) a private folder is created and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)"
            )
        root = tempfile.mkdtemp(prefix="msgtriage-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint root and read it back.

    Cuts the lineage with one computation (a reliable ``checkpoint()`` runs the
    plan a second time to write it) and survives executor loss: the data sits
    in the shared folder, not in executor memory or local disks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    stored = spark.read.parquet(path)
    stored.stored_path = path
    return stored


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage; one that is gone already is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(spark: SparkSession, *stored: DataFrame | str) -> None:
    """Delete tables that ``materialize`` has stored (or folders of their own) and that nothing reads
    any more. Spark removes the shuffle files of ended jobs only after their driver objects are
    collected, so the collection is asked for here."""
    for one in stored:
        delete_path(spark, one if isinstance(one, str) else one.stored_path)
    gc.collect()
    spark._jvm.System.gc()


_stored: dict[tuple[str, str, str], str] = {}


def input_version(spark: SparkSession, paths: list[str]) -> str:
    """Digest of the names, lengths and modification times of all files of ``paths``."""
    import hashlib

    seen = []
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            seen.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.md5(repr(sorted(seen)).encode()).hexdigest()


def materialize_once(spark: SparkSession, name: str, version: str, build) -> DataFrame:
    """The stored table ``name`` for one version of its inputs, built on first use.

    Later calls of the session read the Parquet files written then; other
    versions of the inputs have tables of their own."""
    key = (spark.sparkContext.applicationId, name, version)
    path = spark._jvm.org.apache.hadoop.fs.Path(_stored.get(key, "/"))
    if key not in _stored or not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        path = scratch_path(spark, name)
        build().write.mode("overwrite").parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def drop_stored(spark: SparkSession) -> None:
    """Delete the tables that ``materialize_once`` has stored in this session."""
    for key in [k for k in _stored if k[0] == spark.sparkContext.applicationId]:
        delete_path(spark, _stored.pop(key))


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread rows before CPU-heavy per-row work (tokenising whole texts) when
    the scan yields fewer partitions than there are cores, e.g. a large file
    with one row group. Large inputs already arrive in many splits and pass
    through unchanged, so no shuffle is added where it would not pay off.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def by_key(df: DataFrame, key: str) -> DataFrame:
    """Rows moved by ``key`` while they are still narrow (whole texts, one row each): what a plan later
    groups by the key and more columns, or ranks within the key, then moves no exploded rows. The
    number of partitions grows with the input's splits and is kept by AQE, as exploded rows weigh more."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(n, 8 * df.rdd.getNumPartitions()), key)
