"""Publishing relations: lazy views, fully rebuilt tables, and staged intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def scratch_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session: set by ``setCheckpointDir`` or ``spark.checkpoint.dir``.

    Only a local master may go without either and use a folder of its own.
    """
    chosen = spark.sparkContext.getCheckpointDir()
    if chosen:
        return chosen.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="tenureline-")


def fresh_path(spark: SparkSession, name: str) -> str:
    folder = _SCRATCH.get() or f"{scratch_dir(spark)}/tenureline"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What is staged inside the block ends with it.

    Results are lazy and read what was staged, so write them inside the block too.
    """
    path = fresh_path(spark, "scratch")
    before = _SCRATCH.set(path)
    try:
        yield path
    finally:
        _SCRATCH.reset(before)
        remove(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Compute once, store as Parquet in the shared folder, go on from the files.

    For a relation with several readers. It cuts the lineage, so a lost executor costs
    a re-read and not a recomputation. The files stay until the enclosing ``scratch`` ends.
    """
    return stage_at(df, fresh_path(df.sparkSession, name))


def stage_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_view(df: DataFrame, layer: str, name: str) -> DataFrame:
    """Register a lazily computed relation as ``<layer>__<name>``."""
    view = f"{layer}__{name}"
    df.createOrReplaceTempView(view)
    return df.sparkSession.table(view)


def publish_table(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    bucket_by: str | None = None,
    buckets: int | None = None,
    database: str | None = None,
) -> DataFrame:
    """Rebuild ``<root>/<layer>/<name>`` in full and read it back.

    The rows are written to a folder of their own, which takes the table's place once it is
    complete: a write that fails leaves the table as it was.

    With ``bucket_by`` the table is bucketed in the session catalog, so later joins,
    windows and aggregations on that column need no shuffle. The catalog has one table of a
    name per database, ``layer`` unless ``database`` names another: pipelines with roots of
    their own need databases of their own.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{layer}/{name}"
    version = uuid.uuid4().hex
    fresh = f"{root.rstrip('/')}/{layer}/.{name}-{version}"
    if bucket_by is None:
        with _removed_on_failure(spark, fresh):
            df.write.parquet(fresh)
        _take_place(spark, fresh, path)
        return spark.read.schema(df.schema).parquet(path)
    place = f"`{database or layer}`"
    table, building = f"{place}.`{name}`", f"{place}.`{name}_{version}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {place} LOCATION '{_quoted(path.rsplit('/', 1)[0])}'")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One task per bucket, hence one file per bucket. No exchange is added when the
    # relation already arrives in this partitioning.
    clustered = df.repartition(buckets, bucket_by)
    writer = clustered.write.format("parquet").option("path", fresh)
    with _removed_on_failure(spark, fresh):
        writer.bucketBy(buckets, bucket_by).saveAsTable(building)
    _take_place(spark, fresh, path)
    # the files belong to the path, not to the catalog: dropping a table leaves them
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {building} RENAME TO {table}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(path)}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


@contextmanager
def _removed_on_failure(spark: SparkSession, path: str) -> Iterator[None]:
    try:
        yield
    except BaseException:
        remove(spark, path)
        raise


def _take_place(spark: SparkSession, fresh: str, path: str) -> None:
    """The folder ``fresh`` becomes ``path``; what was there goes when it has."""
    place_of = spark._jvm.org.apache.hadoop.fs.Path
    store = place_of(path).getFileSystem(spark._jsc.hadoopConfiguration())
    before = f"{fresh}-before"
    if store.exists(place_of(path)):
        store.rename(place_of(path), place_of(before))
    store.rename(place_of(fresh), place_of(path))
    spark.catalog.refreshByPath(path)
    remove(spark, before)
