"""The warehouse: source binding -> star schema, written once per input folder.

``load(spark, sf_dir)`` runs the load as a small DAG of Spark jobs that each
write their result under the shared storage root (``spark.checkpoint.dir``)
and returns a ``StoredWarehouse`` that reads those files:

1. request staging — the order-line aggregate (the single lineitem-sized
   shuffle) joined to orders, customers and parts, one wide row per order —
   next to the small reference-table jobs;
2. source tables: requests and surveys as narrow projections of the staging
   table; service types and SLA definitions aggregated from it;
3. dimensions (sizes observed while written, for checked broadcasts), then, in one
   pass over the staging rows with the dimensions broadcast, the fact and the
   quarantine of requests that a lookup fails for: one table, partitioned by ``loaded``.

Written tables cut lineage, so a lost executor costs at most the job in flight.
KPI queries read the stored star schema, as a dashboard would.
"""

from __future__ import annotations

import hashlib
import inspect
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servstar import schemas
from servstar.functions import expr
from servstar.operators import dims, fact
from servstar.operators.joins import MAX_BROADCAST_ROWS, broadcast_if_small
from servstar.operators.keys import KeyMap
from servstar.session import scratch_path
from servstar.sources import binding
from servstar.sources.tables import SourceTables, path_exists, unsorted_writes

SOURCE_TABLES = ("departments", "service_types", "sla_definitions", "service_requests",
                 "user_surveys")
DIM_TABLES = ("dim_department", "dim_service_type", "dim_sla", "dim_time")
STAR_TABLES = DIM_TABLES + ("fact_service_requests",)
#: Requests that the fact leaves out, with the failed lookups (a part of the fact's table).
QUARANTINE = "_quarantine/fact_orphans"


class StoredWarehouse:
    """Source and star tables as written by :func:`load`."""

    def __init__(self, spark: SparkSession, root: str, sizes: dict[str, int]):
        self.spark = spark
        self.root = root
        self.sizes = dict(sizes)
        self._views_for = None
        self._tables: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """The stored table (the file listing is done once and reused)."""
        df = self._tables.get(name)
        if df is None or df.sparkSession is not self.spark:
            if name in ("fact_service_requests", QUARANTINE):  # one table, by partition
                both = _read(self.spark, self.path("fact_service_requests"))
                df = (both.where("loaded = 1").drop("loaded", "missing_keys") if name != QUARANTINE else
                      both.where("loaded = 0").select("request_id", "request_ref", "missing_keys"))
            else:
                df = _read(self.spark, self.path(name))
            self._tables[name] = df
        return df

    def __getattr__(self, name: str) -> DataFrame:
        if name in SOURCE_TABLES or name in STAR_TABLES or name == "service_catalog":
            return self.table(name)
        raise AttributeError(name)

    def dim(self, name: str) -> DataFrame:
        """Dimension with a broadcast hint when its recorded size allows."""
        return broadcast_if_small(self.table(name), MAX_BROADCAST_ROWS,
                                  known_rows=self.sizes.get(name))

    def register_views(self) -> None:
        """Temp views over the stored tables (once per warehouse and session).

        Views carry no broadcast hint: the planner broadcasts a dimension only
        when its file size is under ``spark.sql.autoBroadcastJoinThreshold``.
        """
        with _VIEWS_LOCK:
            if self._views_for is self.spark:
                return
            for name in STAR_TABLES + SOURCE_TABLES:
                self.table(name).createOrReplaceTempView(name)
            self._views_for = self.spark


# Schemas of the tables this process wrote, by path: reading them back with
# the known schema skips the footer-reading job schema inference would run.
_WRITTEN_SCHEMAS: dict[str, T.StructType] = {}


def _write(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        with unsorted_writes(df.sparkSession):
            w.partitionBy(*partition_by).parquet(path)
    else:
        w.parquet(path)
    # partition columns come back last, as discovered from the folder names
    part = set(partition_by or [])
    _WRITTEN_SCHEMAS[path] = T.StructType([f for f in df.schema.fields if f.name not in part]
                                          + [f for f in df.schema.fields if f.name in part])


def _read(spark: SparkSession, path: str) -> DataFrame:
    schema = _WRITTEN_SCHEMAS.get(path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def _committed(spark: SparkSession, path: str) -> bool:
    """True when a job already committed a table at ``path`` (``_SUCCESS``)."""
    return path_exists(spark, f"{path}/_SUCCESS")


def run_steps(steps: dict, parallelism: int | None = None) -> None:
    """Run ``{name: (deps, fn)}`` (listed in dependency order); each step starts
    as soon as its own inputs are done, as a concurrent Spark job."""
    futures = {}
    with ThreadPoolExecutor(max_workers=parallelism or len(steps)) as pool:
        def runner(name):
            deps, fn = steps[name]
            for d in deps:
                futures[d].result()
            fn()
        for name in steps:
            futures[name] = pool.submit(runner, name)
        for fut in futures.values():
            fut.result()


def load(spark: SparkSession, sf_dir: str, root: str | None = None, keys_root: str | None = None) -> StoredWarehouse:
    """Run the load jobs; returns the stored warehouse.

    The steps form a small DAG run as concurrent Spark jobs: the small
    reference and dimension jobs fill slots the lineitem-sized staging job
    leaves idle. A step whose table is already committed under ``root`` is
    skipped, so a re-run after a failure resumes where the last one stopped.
    Surrogate keys are taken from, and new ones added to, the key maps under ``keys_root``
    (default: ``root``), which a later load of changed input should be given again.
    """
    root = root or scratch_path(spark, "warehouse")
    src = SourceTables(spark, sf_dir)
    read = lambda path: _read(spark, path)
    at = lambda name: f"{root}/{name}"
    sizes: dict[str, int] = {}
    key_map = lambda key, natural: KeyMap(spark, f"{keys_root or root + '/_keys'}/{key}", key, natural)

    def write(name, build, partition_by=None, dim=False):
        def run():
            if not _committed(spark, at(name)):
                df = build()
                if dim:  # row count observed while writing: no extra job
                    obs = Observation(f"rows:{name}")
                    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
                _write(df, at(name), partition_by)
                if dim:
                    sizes[name] = obs.get["rows"]
            elif dim:  # resumed step: bounded read of at most MAX_BROADCAST_ROWS + 1 rows
                sizes[name] = read(at(name)).limit(MAX_BROADCAST_ROWS + 1).count()
        return run

    def fact_table():
        wh = StoredWarehouse(spark, root, sizes)
        return fact.fact_and_orphans(read(at("_staging/requests")), wh.dim("dim_department"),
                                     wh.dim("dim_service_type"), wh.dim("dim_sla"), wh.dim("dim_time"))

    staging = lambda: read(at("_staging/requests"))
    steps = {
        "departments": ([], write("departments", lambda: binding.departments(src))),
        "service_catalog": ([], write("service_catalog", lambda: binding.service_catalog(
            src, key_map("service_type_id", "p_type")), dim=True)),
        "_staging/requests": (["service_catalog"], write(
            "_staging/requests", lambda: binding.request_staging(
                src, catalog=StoredWarehouse(spark, root, sizes).dim("service_catalog")))),
        "dim_time": ([], write("dim_time", lambda: dims.dim_time(binding.calendar_bounds(src)),
                               dim=True)),
        "dim_department": (["departments"], write(
            "dim_department", lambda: dims.dim_department(
                read(at("departments")), key_map("dept_key", "department_id")), dim=True)),
        "dim_service_type": (["service_catalog"], write(
            "dim_service_type", lambda: dims.dim_service_type(
                read(at("service_catalog")), key_map("service_key", "service_type_id")), dim=True)),
        # requests and surveys: narrow projections of the staging table
        "service_requests": (["_staging/requests"], write(
            "service_requests", lambda: binding.requests_from_staging(staging()))),
        "user_surveys": (["_staging/requests"], write(
            "user_surveys", lambda: binding.surveys_from_staging(staging()))),
        "service_types": (["service_catalog", "_staging/requests"], write(
            "service_types", lambda: binding.service_types(read(at("service_catalog")),
                                                           staging()))),
        "sla_definitions": (["_staging/requests"], write(
            "sla_definitions", lambda: binding.sla_definitions(staging()))),
        "dim_sla": (["sla_definitions"], write(
            "dim_sla", lambda: dims.dim_sla(
                read(at("sla_definitions")), key_map("sla_key", "sla_id")), dim=True)),
        "fact_service_requests": (
            ["_staging/requests", "dim_department", "dim_service_type", "dim_sla", "dim_time"],
            write("fact_service_requests", fact_table, partition_by=["loaded"])),
    }
    run_steps(steps)
    return StoredWarehouse(spark, root, sizes)


_LOADED: dict[tuple[str, str], StoredWarehouse] = {}
_BOUND: dict[tuple[int, str, str], StoredWarehouse] = {}
_LOCK = threading.Lock()
_VIEWS_LOCK = threading.Lock()


#: Session setting: folder that keeps the warehouse between applications.
ROOT_SETTING = "spark.servstar.root"


def rules_fingerprint() -> str:
    """Digits that change when the code that makes the stored tables does."""
    rules = (schemas, expr, binding, dims, fact)
    return hashlib.md5("".join(inspect.getsource(m) for m in rules).encode()).hexdigest()


def input_fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """16 hex digits that change when a given table's files (path below the table, size, time; partition folders
    included) or the rules do."""
    jvm, parts = spark.sparkContext._jvm, [sf_dir.rstrip("/"), rules_fingerprint()]
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            continue
        files, found = fs.listFiles(path, True), []
        while files.hasNext():
            f = files.next()
            found.append(f"{table} {f.getPath()} {f.getLen()} {f.getModificationTime()}")
        parts += sorted(found)
    return hashlib.md5("\n".join(parts).encode()).hexdigest()[:16]


def lasting_root(spark: SparkSession, sf_dir: str, kind: str = "warehouse") -> str | None:
    """Where the warehouse (or stream) of this input lasts, or None if ``ROOT_SETTING`` isn't set.
    Another input, or changed files, gives another folder."""
    root = spark.conf.get(ROOT_SETTING, None)
    return f"{root.rstrip('/')}/{kind}-{input_fingerprint(spark, sf_dir)}" if root else None


def lasting_keys(spark: SparkSession, sf_dir: str) -> str | None:
    """Where the key maps of this folder last, whatever its files hold by then."""
    root = spark.conf.get(ROOT_SETTING, None)
    return f"{root.rstrip('/')}/keys-{hashlib.md5(sf_dir.rstrip('/').encode()).hexdigest()[:16]}" if root else None


def warehouse(spark: SparkSession, sf_dir: str) -> StoredWarehouse:
    """The stored warehouse for ``sf_dir``: loaded once per Spark application,
    with table handles and views bound to the calling session (sessions of one
    application share the written tables, not their temp views).

    With ``spark.servstar.root`` set, tables last there: a new application takes
    the committed ones and builds only what is missing, also after a load that failed half way."""
    root = lasting_root(spark, sf_dir)
    key = (spark.sparkContext.applicationId, root or sf_dir.rstrip("/"))
    with _LOCK:
        wh = _LOADED.get(key)
        if wh is None:
            wh = load(spark, sf_dir, root, lasting_keys(spark, sf_dir))
            _LOADED[key] = wh
        if wh.spark is spark:
            return wh
        bound = _BOUND.get((id(spark),) + key)
        if bound is None or bound.spark is not spark:
            bound = StoredWarehouse(spark, wh.root, wh.sizes)
            _BOUND[(id(spark),) + key] = bound
        return bound
