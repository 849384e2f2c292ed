"""Parquet and catalog sources and sinks.

Before a partitioned write the rows are rebalanced on the partition columns:
Spark deals them out by those columns, measures the parts, joins small ones
and splits large ones. So a hot partition value (say a third of all rows on
one claim type) is written by as many tasks as its size needs, and a small
one is a single file. The sizes come from the shuffle itself, at any scale;
nothing is sampled beforehand. Unpartitioned tables are rebalanced alike, so
their files have the advisory size whatever the splits of their inputs.

A table is published, not overwritten: its rows go to a fresh folder, and only
when they are all there does the name (or the folder's path) switch to it. A
write that fails leaves the old rows in place.
"""

from __future__ import annotations

import re
import threading
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_dataset(spark: SparkSession, path: str, schema: StructType | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """Scan a (possibly partitioned) directory.

    With a declared schema the partition columns take their declared types
    instead of inferred ones. Columns are re-selected in schema order (a
    partitioned read puts partition columns last), so callers can rely on it.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.select(*[f.name for f in schema.fields]) if schema is not None else df


#: Files that a task of a partitioned write has open at a time; rows of more partitions are sorted first.
OPEN_FILES = 16

_OPEN = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}
_CLEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
_LOCK = threading.Lock()
_held: dict[tuple, tuple] = {}              # by session and setting: how many hold it, its value before


@contextmanager
def lean_writes(spark: SparkSession, presorted: bool = False):
    """Within it the files of a query's shuffles go when the query is done, not when the driver next
    collects its garbage. A partitioned write also sorts no rows where a task has rows of few partitions,
    but keeps a file open for each, unless its rows are ``presorted``. Several threads may be
    within it; the last one puts the session's settings back."""
    settings = _CLEAN if presorted else _CLEAN | _OPEN
    with _LOCK:
        for k, v in settings.items():
            n, old = _held.get((id(spark), k), (0, spark.conf.get(k, None)))
            _held[id(spark), k] = n + 1, old
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _LOCK:
            for k in settings:
                n, old = _held.pop((id(spark), k))
                if n > 1:
                    _held[id(spark), k] = n - 1, old
                elif old is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, old)


def write_partitioned(df: DataFrame, path: str, cols: list[str], compression: str = "snappy",
                      max_records_per_file: int = 0) -> str:
    """Overwrite ``path`` as Parquet partitioned by ``cols``."""
    writer = (df.hint("rebalance", *[F.col(c) for c in cols])
              .write.mode("overwrite").option("compression", compression).partitionBy(*cols))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with lean_writes(df.sparkSession):
        writer.parquet(path)
    return path


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# ---- publishing -------------------------------------------------------------------

#: Versions of a table's files that stay: the current one, and the one that readers may still hold.
KEEP_VERSIONS = 2
_VERSION = re.compile(r"v-\d{14,}-[0-9a-f]{8}")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def stage(df: DataFrame, base: str, fmt: str = "parquet", partition_by: str | None = None,
          deal: bool = True, into: str | None = None) -> str:
    """Write ``df`` to a new version folder below ``base``, or add it to the one (``into``) that is being written.

    With ``deal`` its files have the advisory size: rows are dealt out by the first column, since a
    hash needs no sort, as dealing them out in turn would, and Spark splits what a hot value makes
    large. Without it no row moves: each task of the last step writes its rows, which Spark's splits
    of a scan and its merged and split partitions of a shuffle have sized already. A task that finds rows of
    both states keeps two files open, so nothing is sorted either.
    """
    path = into or f"{base.rstrip('/')}/v-{time.time_ns():019d}-{uuid.uuid4().hex[:8]}"
    writer = (df.hint("rebalance", F.col(f"`{df.columns[0]}`")) if deal else df).write.format(fmt)
    if into:
        writer = writer.mode("append")
    if fmt in ("parquet", "orc"):
        writer = writer.option("compression", "zstd")
    with lean_writes(df.sparkSession):
        (writer.partitionBy(partition_by) if partition_by else writer).save(path)
    return path


def empty_like(spark: SparkSession, schema: StructType, path: str, fmt: str = "parquet") -> str:
    """A dataset of that schema without rows at ``path``."""
    spark.createDataFrame([], schema).write.format(fmt).mode("overwrite").save(path)
    return path


def drop_old_versions(spark: SparkSession, base: str, keep: int = KEEP_VERSIONS, parts: bool = False) -> list[str]:
    """Delete all but the newest ``keep`` version folders below ``base``; other files stay. Versions
    whose parts are tables of their own go only with ``parts``, when all of these have switched."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    found = sorted((x.getPath() for x in fs.listStatus(p) if _VERSION.fullmatch(x.getPath().getName())),
                   key=lambda x: x.getName(), reverse=True)
    old = [x for x in found[keep:] if parts or not any("=" in y.getPath().getName() for y in fs.listStatus(x))]
    for x in old:
        fs.delete(x, True)
    return [x.getName() for x in old]


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def swap_folder(spark: SparkSession, staged: str, path: str) -> str:
    """Put the finished folder ``staged`` at ``path``; what stood there goes only when it has arrived."""
    fs, new = _fs(spark, staged)
    target = _fs(spark, path)[1]
    old = None
    if fs.exists(target):
        old = _fs(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:8]}")[1]
        if not fs.rename(target, old):
            raise OSError(f"can't move {path}")
    try:
        if not (fs.mkdirs(target.getParent()) and fs.rename(new, target)):
            raise OSError(f"can't move {staged} to {path}")
    except Exception:
        if old is not None:
            fs.rename(old, target)
        raise
    if old is not None:
        fs.delete(old, True)
    return path


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location")


def switch_table(spark: SparkSession, name: str, location: str, schema: StructType, fmt: str = "parquet",
                 comment: str = "", properties: dict | None = None) -> str:
    """Let the catalog table ``name`` be the files at ``location``: one change of the catalog where the
    schema stays. A table with another schema is made beside the old one and takes its name."""
    kinds = lambda s: [(f.name, f.dataType) for f in s.fields]
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=location, source=fmt, schema=schema)
    elif kinds(spark.table(name).schema) == kinds(schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(location)}")
        spark.catalog.refreshTable(name)
    else:
        beside = f"{name}_{uuid.uuid4().hex[:8]}"
        spark.catalog.createTable(beside, path=location, source=fmt, schema=schema)
        spark.sql(f"DROP TABLE {name}")           # its files stay: the table is external
        spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    if properties:
        pairs = ", ".join(f"{_quoted(str(k))} = {_quoted(str(v))}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    return name


def table_base(spark: SparkSession, name: str) -> str:
    """The folder for the versions of a table that is given no path: below its schema's location."""
    schema, _, table = name.rpartition(".")
    database = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{table}"


def write_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None,
                comment: str = "", properties: dict | None = None) -> str:
    """Publish ``df`` as a catalog table, with its comment and properties.

    The rows go to a new version folder below ``path`` (or the schema's location);
    then the table switches to it. Old versions go, but for the last.
    """
    spark = df.sparkSession
    base = path or table_base(spark, name)
    switch_table(spark, name, stage(df, base, fmt), df.schema, fmt, comment, properties)
    drop_old_versions(spark, base)
    return name


def compact_table(spark: SparkSession, name: str, fmt: str = "parquet") -> str:
    """Publish a table's rows anew in files of the advisory size: small files of many writes
    become few, large ones are split. Comment and properties stay; readers go on meanwhile."""
    location = table_location(spark, name)
    base, _, last = location.rstrip("/").rpartition("/")
    while not _VERSION.fullmatch(last) and "=" in last:         # the kept rows' part of a version
        base, _, last = base.rpartition("/")
    return write_table(spark.table(name), name, fmt, base if _VERSION.fullmatch(last) else None)


def add_partition(spark: SparkSession, name: str, path: str, schema: StructType, column: str, value: str) -> None:
    """Make the folder ``path/column=value`` a partition of the catalog table ``name``, whose files are below ``path``."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}, `{column}` STRING) USING parquet PARTITIONED BY (`{column}`) "
                  f"LOCATION {_quoted(path)}")
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (`{column}` = {_quoted(value)}) "
              f"LOCATION {_quoted(f'{path}/{column}={value}')}")
    spark.catalog.refreshTable(name)


def rows_to_df(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    """Small driver-side constants only (lineage rows, counts of tables, golden records)."""
    return spark.createDataFrame(rows, schema)


def verify_written(spark: SparkSession, path: str, n: int = 5, order: list[str] | None = None,
                   fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Read a written dataset back: (summary, first n rows).

    The summary is one row (rows, files, partitions). Rows are counted per
    file first, so only a row per file meets in the end: distinct data files
    read and distinct directories holding them (one per partition value
    combination of a partitioned layout). The sample is the first n rows by
    ``order``, or any n rows without one.
    """
    df = spark.read.format(fmt).load(path)
    files = df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    summary = files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("files"),
        F.count_distinct(F.regexp_extract("file", r"^(.*)/[^/]*$", 1)).alias("partitions"))
    return summary, (df.orderBy(*order) if order else df).limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for several tables, one action for all.

    Of a written Parquet table no column is read (``ReadSchema: struct<>``): the
    counts come from the files' footers. Give it written tables, not recipes.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
