"""Readers and writers.

* ``SourceTables`` — the given parquet tables of one input folder (IO1, IO4).
* ``run_sql`` / ``fetch_one`` — SQL text over temp views (IO2, IO3).
* ``seed_table`` / ``resolve_codes`` — reference rows from literals and code
  lookups (IO8, J9).
* ``jdbc_table`` — the same scan against a JDBC database (needs the driver jar
  on the cluster; not exercised offline).
* ``append_table`` / ``load_if_empty`` / ``write_csv`` — sinks (IO5, IO6, IO7).
"""

from __future__ import annotations

import decimal
import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from servstar.functions.expr import lower_names


class SourceTables:
    """Lazy parquet scans of one input folder; column names lower-cased."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._scans: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str, *columns: str) -> DataFrame:
        """Scan of one given table; the listing and schema are resolved once
        and shared by every plan built from this folder (the projection is
        pushed into each scan separately)."""
        df = self._scans.get(name)
        if df is None:
            df = lower_names(self.spark.read.parquet(self.path(name)))
            self._scans[name] = df
        return df.select(*columns) if columns else df


def seed_table(spark: SparkSession, name: str, rows: list[tuple | dict]) -> DataFrame:
    """Small reference rows from literals with the table's declared shape (IO8):
    the given columns in declared order (tuples) or by name (dicts); columns
    left out take their declared default."""
    from servstar import schemas
    target = schemas.TABLES[name]
    if rows and isinstance(rows[0], dict):
        names = [f.name for f in target.fields if f.name in rows[0]]
        rows = [tuple(r.get(n) for n in names) for r in rows]
    else:
        names = [f.name for f in target.fields][:len(rows[0]) if rows else 0]
    part = T.StructType([target[n] for n in names])
    dec = [isinstance(f.dataType, T.DecimalType) for f in part.fields]
    rows = [tuple(decimal.Decimal(str(v)) if d and v is not None and not
                  isinstance(v, decimal.Decimal) else v for v, d in zip(r, dec)) for r in rows]
    return schemas.conform(spark.createDataFrame(rows, part), target)


def resolve_codes(df: DataFrame, lookup: DataFrame, code_col: str, lookup_code: str,
                  id_col: str) -> DataFrame:
    """Replace a natural code with its id from a lookup table (J9). Code
    lookups are reference-table sized, so the lookup is broadcast — after a
    bounded size check; a large one is left to a sort-merge join. Rows whose
    code is unknown keep a NULL id."""
    from pyspark.sql import functions as F

    from servstar.operators.joins import broadcast_if_small
    m = broadcast_if_small(lookup.select(F.col(lookup_code).alias("_code"),
                                         F.col(id_col).alias("_id")))
    return (df.join(m, df[code_col] == F.col("_code"), "left")
              .drop(code_col, "_code").withColumnRenamed("_id", id_col))


def jdbc_table(spark: SparkSession, url: str, table: str, properties: dict,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Parallel JDBC scan (range-split on ``partition_column`` when given)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions))
    return lower_names(reader.load())


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """SQL text over registered views; lower-cased result names."""
    return lower_names(spark.sql(text))


def fetch_one(df: DataFrame) -> Row | None:
    """First row of a (single-row) result, e.g. a global aggregate."""
    rows = df.take(1)
    return rows[0] if rows else None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on any Hadoop-compatible store."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def read_or_none(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Parquet table at ``path``, or None when nothing was written there."""
    if not path_exists(spark, path):
        return None
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException:  # a folder without data files
        return None


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """``INSERT INTO ... SELECT``: append the frame's rows to a parquet table."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


#: Files of different partitions that a task writes at once; with more partitions than these it sorts the rest.
OPEN_FILES = 16
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_writes: dict = {}
_WRITES_LOCK = threading.Lock()


@contextmanager
def unsorted_writes(spark: SparkSession):
    """Inside, ``partitionBy`` writes keep a file open per partition instead of sorting each task's rows first.
    A setting of the session for that long (the last of concurrent writes puts it back): results don't depend on it."""
    with _WRITES_LOCK:
        held = _writes.setdefault(id(spark), [0, None])
        if not held[0]:
            held[1] = spark.conf.get(_OPEN_FILES, None)
            spark.conf.set(_OPEN_FILES, str(OPEN_FILES))
        held[0] += 1
    try:
        yield
    finally:
        with _WRITES_LOCK:
            held[0] -= 1
            if not held[0]:
                if held[1] is None:
                    spark.conf.unset(_OPEN_FILES)
                else:
                    spark.conf.set(_OPEN_FILES, held[1])


def load_if_empty(spark: SparkSession, df: DataFrame, path: str,
                  partition_by: list[str] | None = None) -> bool:
    """Append ``df`` only when the target table has no rows (IO6).

    Unlike ``mode("ignore")`` this also loads into an existing empty table.
    Returns True when rows were loaded.
    """
    existing = read_or_none(spark, path)
    if existing is not None and not existing.isEmpty():
        return False
    append_table(df, path, partition_by)
    return True


def write_csv(df: DataFrame, path: str) -> None:
    """Header, no index, overwrite; one file (only for small aggregate results)."""
    (df.coalesce(1).write.mode("overwrite").option("header", True)
       .option("nullValue", "").csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the committed ``<prefix><number>`` folders under ``path``, ascending."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    ids = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith(prefix) and fs.exists(
                spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            ids.append(int(name[len(prefix):]))
    return sorted(ids)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, path: str, to: str) -> bool:
    """Moves a folder in one step of its store; False if ``to`` exists already or the store refuses."""
    p, fs = _fs(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    return not fs.exists(target) and bool(fs.rename(p, target))
