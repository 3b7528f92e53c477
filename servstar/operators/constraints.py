"""Declared constraints that keep bad rows out of a table (DQ1-DQ6 at load).

A database checks a row when it is inserted. Here the constraints of a table are compiled into one pass that
gives each row the list of those it violates; rows without any are loaded, the others go to quarantine, with the list.

NOT NULL, ranges, value lists and the order of two columns are expressions of the row. A unique key is one
aggregate with map-side combining, whose few repeated keys are joined back, so rows of a hot key aren't gathered; all
rows that share a key violate it. A foreign key is a left join with the parent's distinct keys. NULL passes all but NOT NULL,
as in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from servstar import schemas
from servstar.operators.quality import FOREIGN_KEYS, SCORE_COLUMNS


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"{self.column} is null"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Between:
    column: str
    low: object
    high: object

    @property
    def name(self) -> str:
        return f"{self.column} out of range"

    def broken(self) -> Column:
        return ~F.col(self.column).between(self.low, self.high)


@dataclass(frozen=True)
class OneOf:
    column: str
    values: tuple

    @property
    def name(self) -> str:
        return f"{self.column} not listed"

    def broken(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class NotBefore:
    column: str
    earlier: str

    @property
    def name(self) -> str:
        return f"{self.column} before {self.earlier}"

    def broken(self) -> Column:
        return F.col(self.column) < F.col(self.earlier)


@dataclass(frozen=True)
class Unique:
    columns: tuple

    @property
    def name(self) -> str:
        return f"{','.join(self.columns)} repeated"


@dataclass(frozen=True)
class References:
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"{self.column} not in {self.parent}"


def declared(table: str) -> list:
    """Constraints of a source or star table, from the schemas."""
    out: list = [NotNull(c) for c in schemas.not_null_columns(table)]
    out += [Unique(tuple(k)) for k in schemas.KEYS.get(table, [])]
    out += [References(c, p, pc) for child, c, p, pc in FOREIGN_KEYS if child == table]
    if table == "user_surveys":
        out += [Between(c, 1, 5) for c in SCORE_COLUMNS]
    if table == "service_requests":
        out += [NotBefore("completed_at", "submitted_at"), OneOf("sla_compliant", (0, 1))]
    return out


def with_violations(df: DataFrame, constraints: list, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """``df`` plus ``violations``: the names of the constraints that the row violates, in the order given."""
    broken, added = [], []
    out = df
    for i, c in enumerate(constraints):
        hit = f"_hit{i}"
        if isinstance(c, Unique):
            key = [f"_key{i}_{n}" for n in range(len(c.columns))]
            known = [F.col(x).isNotNull() for x in c.columns]
            some = df
            for k in known:
                some = some.filter(k)
            repeated = some.groupBy(*[F.col(x).alias(k) for x, k in zip(c.columns, key)]).agg(F.count(F.lit(1)).alias(hit)) \
                .filter(F.col(hit) > 1)
            same = [F.col(x) == F.col(k) for x, k in zip(c.columns, key)]
            out = out.join(repeated, same, "left")
            broken.append(F.col(hit).isNotNull())
            added += [*key, hit]
        elif isinstance(c, References):
            key = f"_key{i}"
            keys = parents[c.parent].select(F.col(c.parent_column).alias(key)).distinct().withColumn(hit, F.lit(1))
            out = out.join(keys, F.col(c.column) == F.col(key), "left")
            broken.append(F.col(c.column).isNotNull() & F.col(hit).isNull())
            added += [key, hit]
        else:
            broken.append(F.coalesce(c.broken(), F.lit(False)))
    names = F.array(*[F.when(b, F.lit(c.name)) for b, c in zip(broken, constraints)]) if constraints else F.array().cast("array<string>")
    return out.withColumn("violations", F.filter(names, lambda x: x.isNotNull())).drop(*added)


def load_checked(df: DataFrame, constraints: list, path: str, parents: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes ``df`` in one pass, partitioned by whether a row is accepted, and returns (accepted rows, quarantine with
    ``violations``); a read of either prunes the other."""
    spark: SparkSession = df.sparkSession
    checked = with_violations(df, constraints, parents)
    checked.withColumn("accepted", (F.size("violations") == 0).cast("int")).write.mode("overwrite").partitionBy("accepted").parquet(path)
    both = spark.read.schema(checked.withColumn("accepted", F.lit(1)).schema).parquet(path)
    return both.filter("accepted = 1").drop("accepted", "violations"), both.filter("accepted = 0").drop("accepted")
