"""Written tables in the folder that all executors share, and how long they last.

Tables last until ``clear`` or, if they are made within a ``lifetime``, until its end:

    with scratch.lifetime(spark):
        tags.inverted_list(photos).write.parquet(path)  # leaves nothing but its result
"""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass
class _Scope:
    """A folder below that of the scope around it, and the catalog entries made in it."""

    folder: str = ""
    tables: list[str] = field(default_factory=list)


_WHOLE_RUN = _Scope()
#: Scopes from the whole run inwards. A thread that is started within one is not in it.
_SCOPES: ContextVar[tuple[_Scope, ...]] = ContextVar("scopes", default=(_WHOLE_RUN,))


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir`` or has been given as its
    checkpoint folder. Only a local session that has neither is given a temporary one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        folder = context.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if folder.startswith("file:") and not context.master.startswith("local"):
        warnings.warn(f"{folder} must be a mount that all executors share", stacklevel=2)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str, outside: bool = False) -> str:
    """A path in the shared folder that no other run uses, under the application's name
    so that all it left can be removed at once. ``outside`` of the innermost lifetime, it
    lasts as long as the one around that."""
    scopes = _SCOPES.get()
    scope = scopes[-2] if outside and len(scopes) > 1 else scopes[-1]
    return f"{_run_folder(spark)}{scope.folder}/{name}-{uuid.uuid4().hex}"


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.conf.get('spark.app.id', 'session')}"


def written(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] | None = None,
    outside: bool = False,
    compression: str | None = None,
) -> DataFrame:
    """Write the rows once and read them back: later passes start from the table, also
    after executors are lost, and read only the columns they need. The rows are made when
    this is called; ``clear`` or the end of a lifetime removes them."""
    path = scratch_path(df.sparkSession, name, outside)
    df.write.partitionBy(*partition_by or []).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def without_shuffles(spark: SparkSession) -> Iterator[None]:
    """Tables that are written within leave no shuffle files behind: these go when the table is
    there, not when the driver happens to collect its garbage. For jobs that move much."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def bucketed(df: DataFrame, name: str, parts: int, keys: Sequence[str]) -> DataFrame:
    """The same, laid out by a hash of the keys, so that joins and groups by them need no
    further move. Such a table needs an entry in the catalog, which goes with its files."""
    spark = df.sparkSession
    entry = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    _SCOPES.get()[-1].tables.append(entry)
    (
        df.repartition(parts, *keys)
        .write.bucketBy(parts, *keys)
        .option("path", scratch_path(spark, name))
        .saveAsTable(entry)
    )
    return spark.table(entry)


def _remove(spark: SparkSession, scope: _Scope) -> None:
    for entry in scope.tables:
        spark.sql(f"DROP TABLE IF EXISTS {entry}")
    scope.tables.clear()
    path = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark) + scope.folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def lifetime(spark: SparkSession) -> Iterator[None]:
    """Remove what is written within, files and catalog entries, at the end or on failure.

    Results must be read within it, or be written elsewhere (``outside``). Lifetimes may lie
    in each other; threads that are started within one write to the whole run's folder.
    """
    outer = _SCOPES.get()
    scope = _Scope(f"{outer[-1].folder}/lifetime-{uuid.uuid4().hex}")
    token = _SCOPES.set((*outer, scope))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        _remove(spark, scope)


def clear(spark: SparkSession) -> None:
    """Remove every table this application has written, once its results have been read."""
    _remove(spark, _WHOLE_RUN)
