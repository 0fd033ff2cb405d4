"""Intermediate tables in the shared checkpoint folder, and how long they live."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, with the scheme of its file system.

    Only a local-mode session may go without shared storage; it then gets a fresh folder of its
    own. On a cluster a machine-local folder would be lost with its machine, so without the
    setting the warehouse, which all machines share as well, is taken there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named and context.getCheckpointDir() is None and not context.master.startswith("local"):
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tamis-staging"
    if named:
        path = qualified(spark, named)
        return shared_folder(path, context.master, lambda: reaches_executors(spark, path))
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir().rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as Spark understands it: one without a scheme lies on the default file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return whole.replace("file:/", "file:///", 1) if not whole.startswith("file://") else whole


def shared_folder(path: str, master: str, reached: Callable[[], bool] = lambda: False) -> str:
    """``path``, unless it lies on one machine of a cluster.

    ``file:`` is accepted for a master that runs all its executors on one machine only, and for a
    folder that ``reached`` finds to be a mount of all machines.
    """
    one_machine = master.startswith("local")  # local[n] and local-cluster[n,c,m]
    if path.startswith("file:") and not one_machine and not reached():
        raise RuntimeError(f"spark.checkpoint.dir names a folder of one machine: {path}")
    return path.rstrip("/")


#: By application and path, whether driver and executors see each other's files there.
_REACHED: dict[tuple[str, str], bool] = {}


def reaches_executors(spark: SparkSession, path: str) -> bool:
    """Whether driver and executors read what executors write to ``path``; tried once per application.

    A ``file:`` path may be a mount that all machines share or a disk of each; its name does not
    tell. As many tasks as run at once write a row each, and all rows must be read back.
    """
    context = spark.sparkContext
    tried = (context.applicationId, path)
    if tried not in _REACHED:
        trial, n = f"{path.rstrip('/')}/{context.applicationId}/trial-{uuid.uuid4().hex}", max(2, context.defaultParallelism)
        try:
            spark.range(0, n, 1, n).write.parquet(trial)
            _REACHED[tried] = spark.read.schema("id long").parquet(trial).count() == n
        finally:
            remove_folder(spark, trial)
    return _REACHED[tried]


def owned_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder of this application, below the staging folder."""
    return f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def folder_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session setting ``key`` for what is run inside; as it was, afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Remove the tables at ``paths`` and the shuffle files of the steps that wrote them.

    Spark drops a shuffle's files when the driver's garbage collection finds that nothing refers
    to it any more, which may be half an hour later; here it is asked to look.
    """
    for path in paths:
        remove_folder(spark, path)
    gc.collect()
    spark._jvm.System.gc()


class Scope:
    """The tables staged by one step."""

    def __init__(self, outer: Scope | None):
        self.outer, self.paths = outer, []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Store ``df`` as a table that outlives this scope and belongs to the one around it."""
        return stage_table(df, name, self.outer)


_SCOPE: ContextVar[Scope | None] = ContextVar("scope", default=None)
_HERE = object()


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[Scope]:
    """Tables staged inside are removed at the end, also after an error.

    Only what ``keep`` stored may be used afterwards. Without a scope, tables stay until the
    folder of the application is removed.
    """
    scope = Scope(_SCOPE.get())
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        if scope.paths:
            release(spark, scope.paths)


def stored_result(name: str) -> Callable:
    """Decorates an operator: its result is stored, and the tables it staged on the way are removed."""

    def decorate(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(operator)
        def run(first: DataFrame, *args, **options) -> DataFrame:
            with stage_scope(first.sparkSession) as scope:
                return scope.keep(operator(first, *args, **options), name)

        return run

    return decorate


def stage_table(df: DataFrame, name: str, scope: Scope | None = _HERE) -> DataFrame:
    """Write ``df`` to the staging folder and return it as a scan of what was written.

    This cuts the lineage and survives lost executors. Unlike a checkpointed
    RDD the table stays columnar, so later steps read only the columns they use.
    Tables lie in one folder per application; inside a scope they end with it.
    """
    spark = df.sparkSession
    path = owned_folder(spark, name)
    scope = _SCOPE.get() if scope is _HERE else scope
    if scope is not None:
        scope.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
