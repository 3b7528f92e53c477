"""The fact stored by month, and a summary of it that the KPIs, dashboard datasets and snapshot are read from.

``facts``: the fact partitioned by ``month`` (yyyymm), brought up to date by ``incremental.upsert``: only months with
new, changed or removed rows are rewritten. A query joins the calendar by day *and* month, so a filter on the calendar
(one year) prunes partitions at run time.

``cells``: per (month, department, service, day, surveyed or not, timed or not) counts, sums, minima and maxima, from which every
measure of the KPIs follows by adding up. Its size goes with the dimensions, not with the requests. Each cell
keeps the exclusive or of its rows' hashes; ``refresh`` compares count and hash per month with the facts and rewrites the
months that differ. Progress is thus read from the tables: a run that broke off is completed by the next,
a repeat writes nothing.

Sums are exact decimals; an average is one division of doubles, as over the fact.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servstar import schemas
from servstar.functions.expr import (
    period_label, round_half_even, round_half_up, satisfaction_band, strip_prefix, thousands,
)
from servstar.functions.expr import round_half_up_sql as rnd
from servstar.plans import kpis_sql, marts
from servstar.plans.incremental import upsert, write_by_month
from servstar.plans.warehouse import ROOT_SETTING, warehouse
from servstar.session import scratch_path
from servstar.sources.tables import delete, read_or_none, run_sql

#: What a row is compared by: all but the time of its load.
_CONTENT = [f for f in schemas.FACT_SERVICE_REQUESTS.fields if f.name != "load_timestamp"]
FACTS = T.StructType([*[T.StructField(f.name, f.dataType) for f in _CONTENT],
                      T.StructField("row_hash", T.LongType()), T.StructField("month", T.IntegerType())])
GRAIN = ("month", "dept_key", "service_key", "time_key", "has_survey", "timed")
SCORES = ("satisfaction", "ease_of_use", "response_speed")


# -- the two tables -----------------------------------------------------------------
def by_month(fact: DataFrame) -> DataFrame:
    """The fact's content with ``row_hash`` and ``month``."""
    names = [f.name for f in _CONTENT]
    return fact.select(*names, F.xxhash64(*names).alias("row_hash"), F.expr("time_key div 100").cast("int").alias("month"))


def cells_of(facts: DataFrame) -> DataFrame:
    """The summary of ``facts`` (as of ``by_month``). A sum is NULL where the fact's would be: no value at all."""
    flag = F.col("sla_compliant_flag")
    parts = [F.count("fact_id").alias("requests"), F.sum("has_survey").alias("surveys"), F.count(flag).alias("judged"),
             F.sum(flag).alias("met"), F.sum(F.when(flag == 0, 1).otherwise(0)).alias("missed"),
             F.min("resolution_minutes").alias("minutes_min"), F.max("resolution_minutes").alias("minutes_max")]
    for name, column in [("minutes", "resolution_minutes"), ("hours", "sla_hours_allowed"), *[(s, f"{s}_score") for s in SCORES]]:
        parts += [F.count(column).alias(f"{name}_known"), F.sum(F.col(column).cast("decimal(28,2)")).alias(f"{name}_sum")]
    timed = F.col("resolution_minutes").isNotNull().cast("int")
    return facts.withColumn("timed", timed).groupBy(*GRAIN).agg(*parts, F.bit_xor("row_hash").alias("digest"))


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``; empty where no row was ever written."""
    table = read_or_none(spark, path, schema)
    return spark.createDataFrame([], schema) if table is None else table


def refresh(spark: SparkSession, facts_at: str, cells_at: str) -> list[int]:
    """Brings the summary to the facts; the months that were rewritten."""
    facts = _stored(spark, facts_at, FACTS)
    cells = _stored(spark, cells_at, cells_of(facts).schema)
    now = facts.groupBy("month").agg(F.count("fact_id").alias("n"), F.bit_xor("row_hash").alias("x"))
    had = cells.groupBy(F.col("month").alias("had")).agg(F.sum("requests").alias("had_n"), F.bit_xor("digest").alias("had_x"))
    differs = ~(F.col("n").eqNullSafe(F.col("had_n")) & F.col("x").eqNullSafe(F.col("had_x")))
    both = now.join(had, F.col("month") == F.col("had"), "full_outer").filter(differs)
    rows = both.select("month", "had").collect()  # at most the calendar's months
    stale = sorted(r.month for r in rows if r.month is not None)
    if stale:
        write_by_month(cells_of(facts.filter(F.col("month").isin(stale))), cells_at)
    gone = sorted(r.had for r in rows if r.month is None)
    for month in gone:
        delete(spark, f"{cells_at}/month={month}")
    return stale + gone


def maintain(spark: SparkSession, fact: DataFrame, root: str) -> dict:
    """Takes a full load of the fact into both tables under ``root``: the counts of ``upsert``, and ``months_summed``."""
    done = upsert(by_month(fact), f"{root}/facts", "fact_id", FACTS)
    return done | {"months_summed": len(refresh(spark, f"{root}/facts", f"{root}/cells"))}


class Months:
    """Both tables as stored under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.facts = _stored(spark, f"{root}/facts", FACTS)
        self.cells = _stored(spark, f"{root}/cells", cells_of(self.facts).schema)


_ROOTS: dict[tuple[str, str], str] = {}


def months(spark: SparkSession, sf_dir: str) -> Months:
    """The tables of ``sf_dir``, brought up to date once per application. With ``spark.servstar.root`` set they last
    under the input folder's name, so that a load of changed input rewrites only the months that changed."""
    wh = warehouse(spark, sf_dir)
    lasting = spark.conf.get(ROOT_SETTING, None)
    named = hashlib.md5(sf_dir.rstrip("/").encode()).hexdigest()[:16]
    key = (spark.sparkContext.applicationId, wh.root)
    if key not in _ROOTS:
        root = f"{lasting.rstrip('/')}/months-{named}" if lasting else f"{wh.root}/_months"
        maintain(spark, wh.fact_service_requests, root)
        _ROOTS[key] = root
    return Months(spark, _ROOTS[key])


# -- KPI 1-5 as SQL -----------------------------------------------------------------
def _ratio(part: str, whole: str) -> str:
    return f"CAST(SUM({part}) AS DOUBLE) / CAST(NULLIF(SUM({whole}), 0) AS DOUBLE)"


def _mean(name: str) -> str:
    return _ratio(f"{name}_sum", f"{name}_known")


#: ``kpis_sql.MEASURES`` by adding up cells.
MEASURES = {
    "total_requests": "CAST(SUM(requests) AS BIGINT)",
    "survey_count": "CAST(SUM(surveys) AS BIGINT)",
    "compliant_count": "CAST(SUM(met) AS BIGINT)",
    "breach_count": "CAST(SUM(missed) AS BIGINT)",
    "sla_compliance_pct": rnd(_ratio("met", "requests") + " * 100", 2),
    "breach_pct": rnd(_ratio("missed", "requests") + " * 100", 2),
    "avg_resolution_hours": rnd(_mean("minutes") + " / 60", 2),
    "min_resolution_hours": rnd("CAST(MIN(minutes_min) AS DOUBLE) / 60", 2),
    "max_resolution_hours": rnd("CAST(MAX(minutes_max) AS DOUBLE) / 60", 2),
    **{f"avg_{s}": rnd(_mean(s), 2) for s in SCORES},
    "satisfaction_band": (f"CASE WHEN {_mean('satisfaction')} >= 4.0 THEN 'High Satisfaction' "
                          f"WHEN {_mean('satisfaction')} >= 3.0 THEN 'Medium Satisfaction' ELSE 'Low Satisfaction' END"),
}
#: A KPI's filter on facts, as one on cells.
_FILTERS = {"resolution_minutes IS NOT NULL": "timed = 1", "has_survey = 1": "has_survey = 1"}
KPI_SQL = {name: kpis_sql.kpi(**spec | {"where": _FILTERS.get(spec.get("where")), "source": "request_cells", "measured": MEASURES})
           for name, spec in kpis_sql.KPIS.items()}


def run_kpi(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One KPI statement over the summary of ``sf_dir``."""
    warehouse(spark, sf_dir).register_views()
    months(spark, sf_dir).cells.createOrReplaceTempView("request_cells")
    return run_sql(spark, KPI_SQL[name])


#: The calendar joined by day and month: a filter on it reaches the fact's partitions at run time.
_BY_DAY_AND_MONTH = kpis_sql.DIMENSIONS | {"request_days": ("time_key, month", kpis_sql.DIMENSIONS["dim_time"][1])}
del _BY_DAY_AND_MONTH["dim_time"]


def kpi2_of_year(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    """KPI 2 of one year over the fact by month: twelve partitions are read."""
    wh = warehouse(spark, sf_dir)
    wh.register_views()
    months(spark, sf_dir).facts.createOrReplaceTempView("request_months")
    wh.dim("dim_time").withColumn("month", F.expr("time_key div 100").cast("int")).createOrReplaceTempView("request_days")
    return run_sql(spark, kpis_sql.kpi(**kpis_sql.KPIS["kpi2_sla_sql"] | {"where": f"year_num = {int(year)}"},
                                       source="request_months", dimensions=_BY_DAY_AND_MONTH))


# -- KPI 1-4 as frames --------------------------------------------------------------
def _over(part: str, whole: str) -> F.Column:
    return F.sum(part).cast("double") / F.nullif(F.sum(whole), F.lit(0)).cast("double")


def _average(name: str) -> F.Column:
    return _over(f"{name}_sum", f"{name}_known")


def _total() -> F.Column:
    return F.sum("requests").cast("long").alias("total_requests")


def _grouped(cells: DataFrame, by: list[str], *dims: DataFrame, drop_null: bool = True):
    """``cells`` joined with the columns of ``dims`` that the keys ``by`` need; frames leave out NULL keys."""
    for dim in dims:
        key = next(c for c in dim.columns if c in ("dept_key", "service_key", "time_key"))
        cells = cells.join(dim.select(key, *[c for c in by if c in dim.columns]), key)
    return (cells.dropna(subset=by) if drop_null else cells).groupBy(*by)


def kpi1_resolution(cells: DataFrame, dim_department: DataFrame) -> DataFrame:
    by = ["department_name", "department_sector"]
    hours = {"avg": _average("minutes"), "min": F.min("minutes_min").cast("double"), "max": F.max("minutes_max").cast("double")}
    return _grouped(cells, by, dim_department).agg(
        _total(), *[round_half_even(x / F.lit(60.0), 2).alias(f"{k}_resolution_hours") for k, x in hours.items()]) \
        .orderBy(F.asc_nulls_last("avg_resolution_hours"), *by)


def kpi2_sla(cells: DataFrame, dim_time: DataFrame, dim_service_type: DataFrame) -> DataFrame:
    by = ["year_num", "month_num", "month_name", "service_name"]
    counts = _grouped(cells, by, dim_time, dim_service_type).agg(
        _total(), F.coalesce(F.sum("met"), F.lit(0)).cast("long").alias("compliant_count"))
    share = F.col("compliant_count").cast("double") / F.col("total_requests").cast("double") * F.lit(100.0)
    return counts.withColumn("sla_compliance_pct", round_half_even(share, 2)).orderBy("year_num", "month_num", "service_name")


def kpi3_satisfaction(cells: DataFrame, dim_department: DataFrame, dim_service_type: DataFrame) -> DataFrame:
    by = ["department_name", "service_name"]
    return _grouped(cells.filter("has_survey = 1"), by, dim_department, dim_service_type).agg(
        _total(), *[round_half_even(_average(s), 2).alias(f"avg_{s}") for s in SCORES],
        round_half_even(_over("met", "judged") * F.lit(100.0), 2).alias("sla_compliance_pct")) \
        .withColumn("satisfaction_band", satisfaction_band("avg_satisfaction")) \
        .orderBy(F.desc_nulls_last("avg_satisfaction"), *by)


def kpi4_trend(cells: DataFrame, dim_time: DataFrame) -> DataFrame:
    by = ["year_num", "month_num", "month_name", "quarter_name"]
    return _grouped(cells, by, dim_time).agg(
        _total(), round_half_even(_over("met", "judged") * F.lit(100.0), 2).alias("sla_compliance_pct"),
        round_half_even(_average("satisfaction"), 2).alias("avg_satisfaction"),
        round_half_even(_average("minutes") / F.lit(60.0), 2).alias("avg_resolution_hours")).orderBy("year_num", "month_num")


# -- dashboard datasets and snapshot ------------------------------------------------
def _met_share(digits: int) -> F.Column:
    return round_half_up(_over("met", "requests") * F.lit(100.0), digits)


def _surveyed(digits: int) -> F.Column:
    """Mean satisfaction of the surveyed requests."""
    of = {c: F.when(F.col("has_survey") == 1, F.col(f"satisfaction_{c}")) for c in ("sum", "known")}
    return round_half_up(F.sum(of["sum"]).cast("double") / F.nullif(F.sum(of["known"]), F.lit(0)).cast("double"), digits)


def requests_per_dept(cells: DataFrame, dim_department: DataFrame) -> DataFrame:
    counts = _grouped(cells, ["department_name"], dim_department, drop_null=False).agg(_total())
    return counts.orderBy(F.desc_nulls_first("total_requests"), "department_name") \
        .select(strip_prefix("department_name").alias("department_name"), "total_requests")


def sla_trend(cells: DataFrame, dim_time: DataFrame) -> DataFrame:
    shares = _grouped(cells, ["year_num", "month_num", "month_name"], dim_time, drop_null=False).agg(_met_share(1).alias("sla_pct"))
    target = F.lit(marts.SLA_TARGET_TREND_PCT)
    return shares.withColumns({"period": period_label("month_name", "year_num"), "sla_target_pct": target,
                               "on_target": (F.col("sla_pct") >= target).cast("int")}).orderBy("year_num", "month_num")


def satisfaction_vs_sla(cells: DataFrame, dim_department: DataFrame) -> DataFrame:
    points = _grouped(cells.filter("has_survey = 1"), ["department_name"], dim_department, drop_null=False).agg(
        round_half_up(_average("satisfaction"), 2).alias("avg_satisfaction"), _met_share(1).alias("sla_pct"), _total())
    sla, happy = F.lit(marts.SLA_TARGET_SCATTER_PCT), F.lit(marts.SATISFACTION_TARGET)
    good = (F.col("sla_pct") >= sla) & (F.col("avg_satisfaction") >= happy)
    return points.withColumns({"department_name": strip_prefix("department_name"), "sla_target_pct": sla,
                               "satisfaction_target": happy, "on_target": good.cast("int")})


def resolution_vs_sla(cells: DataFrame, dim_department: DataFrame) -> DataFrame:
    bars = _grouped(cells, ["department_name"], dim_department, drop_null=False).agg(
        round_half_up(_average("minutes") / F.lit(60.0), 1).alias("avg_hours"), round_half_up(_average("hours"), 1).alias("sla_hours"))
    return bars.orderBy(F.desc_nulls_first("avg_hours"), "department_name") \
        .select(strip_prefix("department_name").alias("department_name"), "avg_hours", "sla_hours")


def kpi_tiles(cells: DataFrame) -> DataFrame:
    tiles = cells.agg(F.coalesce(F.sum("requests"), F.lit(0)).alias("total_requests"), _met_share(1).alias("sla_compliance_pct"),
                      _surveyed(2).alias("avg_satisfaction"), round_half_up(_average("minutes") / F.lit(60.0), 1).alias("avg_resolution_hours"))
    text = {"sla_compliance": ("sla_compliance_pct", "%"), "avg_satisfaction": ("avg_satisfaction", " / 5.0"),
            "avg_resolution": ("avg_resolution_hours", " hrs")}
    return tiles.select("*", thousands("total_requests").alias("total_requests_text"),
                        *[F.concat(F.col(c).cast("string"), F.lit(unit)).alias(f"{n}_text") for n, (c, unit) in text.items()])


def load_snapshot(cells: DataFrame) -> DataFrame:
    return cells.agg(round_half_up(_average("minutes") / F.lit(60.0), 2).alias("avg_resolution_hours"),
                     _met_share(2).alias("sla_compliance_pct"), _surveyed(2).alias("avg_satisfaction"),
                     F.coalesce(F.sum("requests"), F.lit(0)).alias("total_rows"))


#: Name of the query over the fact -> the same over the summary, and the dimensions it joins.
FRAMES = {
    "kpi1_resolution_frame": (kpi1_resolution, "dim_department"),
    "kpi2_sla_frame": (kpi2_sla, "dim_time", "dim_service_type"),
    "kpi3_satisfaction_frame": (kpi3_satisfaction, "dim_department", "dim_service_type"),
    "kpi4_trend_frame": (kpi4_trend, "dim_time"),
    "mart_requests_per_dept": (requests_per_dept, "dim_department"),
    "mart_sla_trend": (sla_trend, "dim_time"),
    "mart_satisfaction_vs_sla": (satisfaction_vs_sla, "dim_department"),
    "mart_resolution_vs_sla": (resolution_vs_sla, "dim_department"),
    "mart_kpi_tiles": (kpi_tiles,),
    "load_snapshot": (load_snapshot,),
}


def run_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``FRAMES`` over the summary of ``sf_dir``."""
    wh, (build, *dims) = warehouse(spark, sf_dir), FRAMES[name]
    return build(months(spark, sf_dir).cells, *[wh.dim(d) for d in dims])


# -- an earlier load, the present one, and that once more ---------------------------------
def earlier(fact: DataFrame) -> DataFrame:
    """The fact as an earlier load might have left it: every seventh request of the present wasn't there, of the first
    quarters every eleventh had no survey yet."""
    late = (F.col("fact_id") % 11 == 0) & (F.expr("time_key div 100 % 100") <= 3)
    none = {f"{s}_score": F.when(~late, F.col(f"{s}_score")) for s in SCORES}
    return fact.filter("fact_id % 7 <> 0 or time_key div 100 % 100 > 6").withColumns(
        none | {"has_survey": F.when(late, 0).otherwise(F.col("has_survey"))})


_RUNS: dict = {}


def _three_loads(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _RUNS:
        root, fact = scratch_path(spark, "months"), warehouse(spark, sf_dir).fact_service_requests
        _RUNS[key] = root, [maintain(spark, f, root) for f in (earlier(fact), fact, fact)]
    return _RUNS[key]


COUNTS = ("new_rows", "changed_rows", "removed_rows", "months_written", "months_summed")


def summary_maintained(spark, sf_dir):
    """What the three loads did to the fact by month and to its summary."""
    runs = _three_loads(spark, sf_dir)[1]
    return spark.createDataFrame([(k + 1, *[r[c] for c in COUNTS]) for k, r in enumerate(runs)],
                                 "run int, " + ", ".join(f"{c} long" for c in COUNTS))


def summary_cells(spark, sf_dir):
    """The summary after them."""
    return Months(spark, _three_loads(spark, sf_dir)[0]).cells.select(
        *GRAIN, "requests", F.col("surveys").cast("long").alias("surveys"), "judged", F.col("met").cast("long").alias("met"),
        F.col("missed").cast("long").alias("missed"), *[F.col(c).cast("double").alias(c) for c in (
            "minutes_sum", "minutes_min", "minutes_max", "satisfaction_sum")])
