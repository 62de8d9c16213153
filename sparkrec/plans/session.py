"""Session, shared checkpoint folder and materialized stages.

Lineage is cut by writing a stage as Parquet under the folder the cluster
names in ``spark.checkpoint.dir`` (a shared file system). Such a table
survives the loss of any executor, carries exact file statistics for the
optimizer, and is read back with column pruning and filter pushdown.
A folder of our own is only chosen when the setting is unset and the
master is local (tests, benchmarks).
"""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app_name: str = "sparkrec", **conf: str) -> SparkSession:
    """A ``local[cores]`` session for tests and the benchmark.

    Static broadcast joins are switched off (their size estimate comes from
    file sizes, not from the data); AQE still turns a shuffle join into a
    broadcast join once a side's measured shuffle output is small, and it
    splits skewed join partitions.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.default.parallelism", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SETTING_LOCK = threading.Lock()
_SETTING_USERS: dict[str, list] = {}


def _value(spark: SparkSession, key: str) -> str | None:
    """The session setting, its default included; None if this Spark does not know it."""
    try:
        return spark.conf.get(key)
    except Exception:  # noqa: BLE001 - unset key without a default
        return None


@contextmanager
def _setting(spark: SparkSession, key: str, change: Callable[[str | None], str]):
    """The session setting ``key`` is ``change(old)`` meanwhile; the last of several users restores it."""
    with _SETTING_LOCK:
        users = _SETTING_USERS.setdefault(key, [0, _value(spark, key)])
        users[0] += 1
        spark.conf.set(key, change(_value(spark, key)))
    try:
        yield
    finally:
        with _SETTING_LOCK:
            users[0] -= 1
            if not users[0]:
                old = _SETTING_USERS.pop(key)[1]
                spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def at_least(spark: SparkSession, key: str, value: int):
    """The session setting ``key`` is ``value`` or more meanwhile (nested and concurrent use is fine)."""
    return _setting(spark, key, lambda old: str(max(int(old), value)))


def held(spark: SparkSession, key: str, value: str):
    """The session setting ``key`` is ``value`` meanwhile (concurrent users must agree)."""
    return _setting(spark, key, lambda old: value)


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """The SparkContext's checkpoint folder, set from ``spark.checkpoint.dir``.

    On a cluster the setting must name a shared folder; it is an error to
    run without one. Only a local master gets a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured is None:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder "
                "(HDFS, S3, ...) that every executor can reach"
            )
        configured = tempfile.mkdtemp(prefix="sparkrec-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


class Stage(NamedTuple):
    """A written table and its own path, which :meth:`Workspace.remove` takes."""

    table: DataFrame
    path: str


class Workspace:
    """A private folder under the shared checkpoint dir for one job's stages.

    Several driver threads may write stages of one workspace: nothing about a
    stage is kept in shared state.
    """

    def __init__(self, spark: SparkSession, name: str = "sparkrec"):
        self.spark = spark
        root = shared_checkpoint_dir(spark).rstrip("/")
        self.path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
        self._catalog: list[str] = []

    def location(self, name: str) -> str:
        return f"{self.path}/{name}"

    def materialize(
        self,
        df: DataFrame,
        name: str,
        partition_by: list[str] | None = None,
        partitions: int | None = None,
    ) -> DataFrame:
        """Write ``df`` as Parquet and return it read back (lineage cut).

        Every call gets a fresh path, so a stage is never overwritten while a
        lazy DataFrame built on an earlier one may still read it.

        With ``partitions`` the rows are spread round-robin over that many
        files before the write, so later stages run in parallel whatever
        the input's file layout.
        """
        return self.stage(df, name, partition_by, partitions).table

    def stage(
        self,
        df: DataFrame,
        name: str,
        partition_by: list[str] | None = None,
        partitions: int | None = None,
        row_group: int | None = None,
    ) -> Stage:
        """:meth:`materialize`, with the stage's own path beside its table; ``row_group`` as in :meth:`bucketed_stage`."""
        path = self.location(f"{name}-{uuid.uuid4().hex[:8]}")
        frame = df.repartition(partitions) if partitions else df
        writer = frame.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if row_group:
            writer = writer.option("parquet.block.size", row_group)
        writer.parquet(path)
        # the schema is known: no job reads it from a file's footer
        return Stage(self.spark.read.schema(frame.schema).parquet(path), path)

    def bucketed(self, df: DataFrame, name: str, columns: list[str], buckets: int) -> DataFrame:
        """Write ``df`` bucketed by ``columns`` and return it read back: joins on
        those columns do not move it again."""
        table = f"{name}_{uuid.uuid4().hex[:8]}"
        writer = df.repartition(buckets, *columns).write.bucketBy(buckets, *columns)
        writer.format("parquet").option("path", self.location(table)).saveAsTable(table)
        self._catalog.append(table)
        return self.spark.table(table)

    def bucketed_stage(self, df: DataFrame, name: str, columns: list[str], buckets: int, partition_by: list[str] | None = None,
                       row_group: int | None = None) -> Stage:
        """Write ``df`` bucketed and sorted by ``columns`` as its rows lie, without a shuffle, and return it
        read back with its path. Each task writes a file per bucket (and folder) that it has rows of.
        ``row_group``: bytes of a file's row groups, which a reader holds whole."""
        part = uuid.uuid4().hex[:8]
        table, path = f"{name}_{part}", self.location(f"{name}-{part}")
        writer = df.write.bucketBy(buckets, *columns).sortBy(*columns)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if row_group:
            writer = writer.option("parquet.block.size", row_group)
        writer.format("parquet").option("path", path).saveAsTable(table)
        self._catalog.append(table)
        return Stage(self.spark.table(table), path)

    def tables(self) -> list[str]:
        """Names of the stages that are written and not yet removed."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []

    def drop_at_exit(self) -> "Workspace":
        """Delete the folder when this process ends (its session must still run)."""
        atexit.register(self._drop_if_running)
        return self

    def _drop_if_running(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            self.drop()

    def remove(self, path: str) -> None:
        """Delete one stage written by :meth:`materialize` (no longer read)."""
        if not path.startswith(self.path):
            raise ValueError(f"{path} is not in this workspace")
        table = path[len(self.path) + 1:].replace("-", "_")
        if table in self._catalog:
            self._catalog.remove(table)
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._delete(path)

    def drop(self) -> None:
        """Delete the folder through the Hadoop file system of its URI."""
        while self._catalog:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog.pop()}")
        self._delete(self.path)

    def _delete(self, where: str) -> None:
        jvm = self.spark.sparkContext._jvm
        hadoop_conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(hadoop_conf).delete(path, True)

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *exc) -> None:
        self.drop()
