"""Session helpers: a configured SparkSession and a shared scratch folder.

The library itself never creates a session; every operator takes DataFrames.
These helpers are for tests, ``bench.py`` and small scripts.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every plan of this library is written for.  AQE re-plans joins
# from measured sizes (broadcast only below the threshold), coalesces small
# shuffle partitions and splits skewed join partitions at run time.  It may
# also run a sort-merge join as a shuffled hash join, but only when every
# partition of the build side is measured at or below 64 MB (the advisory
# partition size), so each in-memory hash table stays bounded; skewed or
# large partitions keep the sort-merge join.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tillroll", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with :data:`DEFAULT_CONF` applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    This is ``spark.checkpoint.dir`` (a shared file system the cluster names).
    A session without one is an error on a cluster, whose machines do not share
    their folders; on a ``local`` master a fresh folder is made and registered.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below :func:`scratch_root` (one per call)."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; a missing one is fine."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scope:
    """Owner of the intermediates of one operation: folders, tables and views.

    Folders are made below :func:`scratch_root`, so all executors share them.
    ``release`` takes tables and views out of the catalog (a frame that was
    read from one stays readable, since its plan names the files), ``close``
    deletes the folders too.  As a context manager it closes at the end, with
    or without an error::

        with Scope(spark) as scope:
            basket = scope.keep(basket, "basket")   # written and read back
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._folders: list[str] = []
        self._tables: list[str] = []
        self._views: list[str] = []

    def path(self, name: str) -> str:
        """A new folder's path, deleted by ``close``."""
        self._folders.append(scratch_path(self.spark, name))
        return self._folders[-1]

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame as Parquet and read it back: its lineage ends there."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, name: str) -> str:
        """Own a catalog table (of this name, when it is made)."""
        self._tables.append(name)
        return name

    def view(self, df: DataFrame, stem: str) -> str:
        """A temporary view of a frame under a fresh name."""
        name = f"{stem}_{uuid.uuid4().hex[:12]}"
        df.createOrReplaceTempView(name)
        self._views.append(name)
        return name

    def drop(self, path: str) -> None:
        """Delete one folder now."""
        self._folders.remove(path)
        remove_folder(self.spark, path)

    def release(self) -> None:
        """Drop the owned tables and views; folders stay."""
        while self._views:
            self.spark.catalog.dropTempView(self._views.pop())
        while self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")

    def close(self) -> None:
        self.release()
        while self._folders:
            remove_folder(self.spark, self._folders.pop())

    def __enter__(self) -> Scope:
        return self

    def __exit__(self, *_) -> None:
        self.close()
