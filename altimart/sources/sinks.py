"""Where results go: tables, views, triple files, JSON text of small answers."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_model(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    files_by: Sequence[str] = (),
    options: Mapping[str, str] = {},
) -> DataFrame:
    """Full refresh of a model as parquet; returns the written table.

    ``files_by`` clusters rows into files by these columns before writing, which
    keeps a partitioned write from opening every partition in every task.
    """
    if files_by:
        df = df.repartitionByRange(*files_by)
    beside = f"{path}.new-{uuid.uuid4().hex}"
    writer = df.write.options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        with _shuffle_files_let_go(df.sparkSession):
            writer.parquet(beside)
    except BaseException:
        remove(df.sparkSession, beside)
        raise
    _switch(df.sparkSession, beside, path)
    return df.sparkSession.read.schema(_schema(df, partition_by)).parquet(path)


_LET_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffle_files_let_go(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is run inside go when it has run, not when the driver collects its garbage."""
    before = spark.conf.get(_LET_GO, None)
    spark.conf.set(_LET_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_LET_GO)
        else:
            spark.conf.set(_LET_GO, before)


def _schema(df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    """Columns as they come back: partition columns last, all of them nullable."""
    inside = [f for f in df.schema.fields if f.name not in partition_by]
    kinds = {f.name: f for f in df.schema.fields}
    return T.StructType([T.StructField(f.name, f.dataType) for f in [*inside, *[kinds[p] for p in partition_by]]])


def _files(spark: SparkSession, path: str):
    """The file system of a path, and a maker of paths on it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def remove(spark: SparkSession, path: str) -> None:
    """A folder and all in it; nothing where there is none."""
    files, make = _files(spark, path)
    files.delete(make(path), True)


def _switch(spark: SparkSession, new: str, path: str) -> None:
    """``new`` takes the place of ``path``, by two renames: a table is there before and after, whole.

    If the second rename fails the old table is put back.
    """
    files, make = _files(spark, path)
    old = f"{path}.old-{uuid.uuid4().hex}"
    had = files.exists(make(path))
    if had and not files.rename(make(path), make(old)):
        raise OSError(f"cannot move {path} away; {new} holds the new table")
    if not files.rename(make(new), make(path)):
        if had:
            files.rename(make(old), make(path))
        raise OSError(f"cannot move {new} to {path}")
    if had:
        files.delete(make(old), True)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Full refresh of a model as a catalog table clustered and sorted by a key; returns the table.

    Joins and groupings by the key read buckets side by side: tables with equally many buckets of the
    same key meet without an exchange.  A row is in the bucket of its key, so a hot key makes a large
    bucket; use it for keys such as customers whose largest share is bounded, and ``write_model`` with
    ``lookup_join`` otherwise.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def register_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """A table of ``write_bucketed`` made known to a session with another catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"create table if not exists {name} ({columns}) using parquet"
        f" clustered by (`{key}`) sorted by (`{key}`) into {buckets} buckets location '{path}'"
    )
    return spark.table(name)


def shared_folder(spark: SparkSession) -> str | None:
    """Folder every executor can reach for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session,
    whose executors are this process, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named
    if not spark.conf.get("spark.master", "").startswith("local"):
        return None
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="altimart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the application's folder below the shared one; the folder goes when the driver ends.

    On a cluster that names no shared folder this is an error.
    """
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError(f"set spark.checkpoint.dir: {name} needs a folder that all executors share")
    own = f"{folder}/altimart-{spark.sparkContext.applicationId}"
    _removed_at_exit(spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


_RUN_FOLDERS: set[str] = set()


def _removed_at_exit(spark: SparkSession, folder: str) -> None:
    """Handlers run last in, first out: this one before the driver's JVM is shut down."""
    if folder not in _RUN_FOLDERS:
        _RUN_FOLDERS.add(folder)
        files, make = _files(spark, folder)
        atexit.register(lambda: files.delete(make(folder), True))


def materialised(df: DataFrame, name: str, partition_by: Sequence[str] = (), files_by: Sequence[str] = ()) -> DataFrame:
    """The same rows read back from a written table: cuts lineage, shares work."""
    path = scratch(df.sparkSession, name)
    return write_model(df, path, partition_by, files_by).select(*df.columns)


def materialised_parts(parts: Iterable[DataFrame], name: str, options: Mapping[str, str] = {}) -> DataFrame:
    """The rows of several frames read back from one table, which is written frame by frame.

    The shuffle files of a frame go before those of the next one are made.
    """
    tables, path = [], ""
    for df in parts:
        path = path or scratch(df.sparkSession, name)
        write_model(df, f"{path}/{len(tables)}", options=options)
        tables.append(f"{path}/{len(tables)}")
    return df.sparkSession.read.schema(_schema(df, ())).parquet(*tables)


def kept(df: DataFrame) -> DataFrame:
    """The same rows from a checkpoint in the shared folder: cuts lineage, for loops and small frames.

    Spark removes a checkpoint when nothing refers to it any more, where the session has
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` set.  The rows are held on the executors' disks
    until the checkpoint is written, so they are computed once and their real size is known.
    """
    spark, context = df.sparkSession, df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = shared_folder(spark)
        if folder is None:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder)
    held = df.persist(StorageLevel.DISK_ONLY)
    try:
        return held.select("*").checkpoint(eager=True)
    finally:
        held.unpersist()


def _escaped(c: Column) -> Column:
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def ntriples_lines(triples: DataFrame) -> DataFrame:
    """One N-Triples line per triple."""

    def iri(c: Column) -> Column:
        return F.concat(F.lit("<"), c, F.lit(">"))

    tag = F.when(F.startswith("dtype", F.lit("@")), F.col("dtype"))
    kind = F.coalesce(tag, F.concat(F.lit("^^"), iri(F.col("dtype"))), F.lit(""))
    literal = F.concat(F.lit('"'), _escaped(F.col("o")), F.lit('"'), kind)
    value = F.when(F.col("is_iri"), iri(F.col("o"))).otherwise(literal)
    return triples.select(F.concat_ws(" ", iri(F.col("s")), iri(F.col("p")), value, F.lit(".")))


def write_ntriples(triples: DataFrame, path: str) -> None:
    ntriples_lines(triples).write.mode("overwrite").text(path)


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row, computed and kept on the cluster."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def json_answer(df: DataFrame, at_most: int) -> str:
    """A small answer as the text of one JSON array; refuses to cut a longer one short."""
    rows = [r["json"] for r in json_rows(df).take(at_most + 1)]
    if len(rows) > at_most:
        raise ValueError(f"answer has more than {at_most} rows; use json_rows and write it")
    return "[" + ",\n ".join(rows) + "]"
