"""Data-quality checks from the declared constraints (DQ1-DQ6).

A database rejects violating rows; on files Spark enforces nothing, so each
constraint becomes a check that reports (and, for foreign keys, separates)
violations.

Scale: key checks are ``groupBy(key).count()`` (map-side partial counts, so a
key holding a large share of rows collapses before the shuffle); NOT NULL and
range checks are one pass of ``count_if`` per table; foreign keys are left joins
of each child table with its parents' distinct keys, one aggregate per child.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar import schemas


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def key_profile(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """One row: rows, distinct key values, NULL-key rows, duplicated values and
    the rows carrying them (DQ1 primary key, DQ2 unique)."""
    null_key = None
    for k in key:
        c = F.col(k).isNull()
        null_key = c if null_key is None else null_key | c
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"),
                                   F.max(null_key.cast("int")).alias("is_null"))
    return per_key.agg(
        F.sum("n").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.sum(F.when(F.col("is_null") == 1, F.col("n")).otherwise(0)).alias("null_key_rows"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("duplicated_rows"),
    ).select(F.lit(table).alias("table_name"), F.lit(",".join(key)).alias("key_columns"),
             F.coalesce("total_rows", F.lit(0)).cast("long").alias("total_rows"),
             F.col("distinct_keys").cast("long").alias("distinct_keys"),
             F.coalesce("null_key_rows", F.lit(0)).cast("long").alias("null_key_rows"),
             F.col("duplicated_keys").cast("long").alias("duplicated_keys"),
             F.coalesce("duplicated_rows", F.lit(0)).cast("long").alias("duplicated_rows"))


def table_key_profiles(df: DataFrame, table: str, keys: list[list[str]]) -> DataFrame:
    """``key_profile`` rows for several keys of one table from one scan: the
    per-key counts come from one GROUPING SETS aggregate (an Expand, one
    shuffle) instead of one scan and shuffle per key."""
    if len(keys) == 1:
        return key_profile(df, table, keys[0])
    cols = list(dict.fromkeys(c for key in keys for c in key))
    flags = []
    for i, key in enumerate(keys):
        nk = None
        for c in key:
            nk = F.col(c).isNull() if nk is None else nk | F.col(c).isNull()
        flags.append(nk.cast("int").alias(f"_nk{i}"))
    per_key = (df.select(*cols, *flags)
               .groupingSets([[F.col(c) for c in key] for key in keys], *cols)
               .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid"),
                    *[F.max(f"_nk{i}").alias(f"_nk{i}") for i in range(len(keys))]))
    # grouping_id: one bit per grouping column, set when the column is not in the set
    gids = [sum(1 << (len(cols) - 1 - j) for j, c in enumerate(cols) if c not in key)
            for key in keys]
    aggs = []
    for i, gid in enumerate(gids):
        mine = F.col("_gid") == gid
        aggs += [F.sum(F.when(mine, F.col("n"))).alias(f"rows{i}"),
                 F.count_if(mine).alias(f"keys{i}"),
                 F.sum(F.when(mine & (F.col(f"_nk{i}") == 1), F.col("n"))).alias(f"nulls{i}"),
                 F.count_if(mine & (F.col("n") > 1)).alias(f"dupk{i}"),
                 F.sum(F.when(mine & (F.col("n") > 1), F.col("n"))).alias(f"dupr{i}")]
    rows = ", ".join(f"'{','.join(key)}', rows{i}, keys{i}, nulls{i}, dupk{i}, dupr{i}"
                     for i, key in enumerate(keys))
    stacked = per_key.agg(*aggs).select(F.expr(
        f"stack({len(keys)}, {rows}) AS (key_columns, total_rows, distinct_keys, "
        "null_key_rows, duplicated_keys, duplicated_rows)"))
    return stacked.select(
        F.lit(table).alias("table_name"), "key_columns",
        F.coalesce("total_rows", F.lit(0)).cast("long").alias("total_rows"),
        F.col("distinct_keys").cast("long").alias("distinct_keys"),
        F.coalesce("null_key_rows", F.lit(0)).cast("long").alias("null_key_rows"),
        F.col("duplicated_keys").cast("long").alias("duplicated_keys"),
        F.coalesce("duplicated_rows", F.lit(0)).cast("long").alias("duplicated_rows"))


def duplicate_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Key profiles for every declared key of every given table (one scan per
    table)."""
    return _union([table_key_profiles(df, name, schemas.KEYS[name])
                   for name, df in tables.items() if schemas.KEYS.get(name)])


def duplicate_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """The key values that occur more than once, with their counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_counts(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """(table_name, column_name, null_count) for the NOT NULL columns (DQ3),
    from one aggregate pass over the table."""
    columns = columns if columns is not None else schemas.not_null_columns(table)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.select(F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, null_count)")) \
              .select(F.lit(table).alias("table_name"), "column_name",
                      F.col("null_count").cast("long").alias("null_count"))


def all_null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([null_counts(df, name) for name, df in tables.items()
                   if schemas.not_null_columns(name)])


# Declared foreign keys: (child table, child column, parent table, parent column).
FOREIGN_KEYS = (
    ("service_types", "department_id", "departments", "department_id"),
    ("sla_definitions", "service_type_id", "service_types", "service_type_id"),
    ("service_requests", "department_id", "departments", "department_id"),
    ("service_requests", "service_type_id", "service_types", "service_type_id"),
    ("service_requests", "sla_id", "sla_definitions", "sla_id"),
    ("user_surveys", "request_id", "service_requests", "request_id"),
    ("fact_service_requests", "dept_key", "dim_department", "dept_key"),
    ("fact_service_requests", "service_key", "dim_service_type", "service_key"),
    ("fact_service_requests", "time_key", "dim_time", "time_key"),
    ("fact_service_requests", "sla_key", "dim_sla", "sla_key"),
)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (a NULL key passes a
    foreign key; NOT NULL is checked separately)."""
    p = parent.select(F.col(parent_column).alias("_pk")).distinct()
    return (child.where(F.col(column).isNotNull())
                 .join(p, F.col(column) == F.col("_pk"), "left_anti"))


def split_valid(child: DataFrame, column: str, parent: DataFrame,
                parent_column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a parent, quarantined rows) — DQ5 without failing the load."""
    p = parent.select(F.col(parent_column).alias("_pk")).distinct()
    valid = child.join(p, F.col(column) == F.col("_pk"), "left_semi")
    bad = child.join(p, F.col(column) == F.col("_pk"), "left_anti")
    return valid, bad


def orphan_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(child, column, parent, checked_rows, null_rows, orphan_rows) per FK (DQ4, DQ5).

    One pass per child table: it is joined (left) to the distinct keys of each
    of its parents — broadcast when a parent is small, as dimensions are — and
    every count comes from a single aggregate, so the fact is scanned once for
    its four foreign keys rather than four times."""
    by_child: dict[str, list] = {}
    for child, col, parent, pcol in FOREIGN_KEYS:
        if child in tables and parent in tables:
            by_child.setdefault(child, []).append((col, parent, pcol))
    parts = []
    for child, fks in by_child.items():
        joined = tables[child].select(*sorted({col for col, _, _ in fks}))
        aggs = [F.count(F.lit(1)).cast("long").alias("checked_rows")]
        for i, (col, parent, pcol) in enumerate(fks):
            keys = (tables[parent].select(F.col(pcol).alias(f"_pk{i}")).distinct()
                    .withColumn(f"_hit{i}", F.lit(1)))
            joined = joined.join(keys, F.col(col) == F.col(f"_pk{i}"), "left")
            aggs += [F.count_if(F.col(col).isNull()).cast("long").alias(f"null{i}"),
                     F.count_if(F.col(col).isNotNull() & F.col(f"_hit{i}").isNull())
                     .cast("long").alias(f"orphan{i}")]
        # one row of counts, unpivoted by a single stack (one plan branch per
        # child, so the scan and the aggregate are not repeated per key)
        rows = ", ".join(f"'{col}', '{parent}', checked_rows, null{i}, orphan{i}"
                         for i, (col, parent, _) in enumerate(fks))
        parts.append(joined.agg(*aggs).select(
            F.lit(child).alias("child_table"),
            F.expr(f"stack({len(fks)}, {rows}) AS (child_column, parent_table, "
                   "checked_rows, null_rows, orphan_rows)")))
    return _union(parts)


SCORE_COLUMNS = ("satisfaction_score", "ease_of_use_score", "response_speed_score")


def score_range(surveys: DataFrame, low: float = 1.0, high: float = 5.0,
                columns=SCORE_COLUMNS) -> DataFrame:
    """(column_name, checked, out_of_range) for CHECK score BETWEEN 1 AND 5
    (DQ6, PF13); NULL passes a CHECK."""
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__n"),
                 F.count_if(~F.col(c).between(low, high)).alias(f"{c}__bad")]
    agg = surveys.agg(*aggs)
    pairs = ", ".join(f"'{c}', `{c}__n`, `{c}__bad`" for c in columns)
    return agg.select(F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, checked, out_of_range)")) \
              .select("column_name", F.col("checked").cast("long"),
                      F.col("out_of_range").cast("long"))


def out_of_range_rows(surveys: DataFrame, low: float = 1.0, high: float = 5.0,
                      columns=SCORE_COLUMNS) -> DataFrame:
    cond = None
    for c in columns:
        bad = F.col(c).isNotNull() & ~F.col(c).between(low, high)
        cond = bad if cond is None else cond | bad
    return surveys.where(cond)
