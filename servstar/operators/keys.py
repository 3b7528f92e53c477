"""Surrogate keys that last (F26).

A key map is a stored table of natural keys and their numbers. It only grows: ``extend`` numbers the natural keys that
it lacks, after the largest number given so far, and adds them as one folder ``run=<n>``; what has a number
keeps it over every reload. A run that fails is repeated under the same folder name.

New keys are dealt to tasks by ranges and sorted there; a task numbers its own, and the tasks' counts (one number per task)
give each its offset. So within a run keys ascend with the natural key, whatever the number of tasks, and no
task sees all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servstar.session import scratch_path
from servstar.sources.tables import folder_numbers


class KeyMap:
    """Numbers ``key`` of the natural key columns ``natural``, stored under ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, *natural: str):
        self.spark, self.path, self.key, self.natural = spark, path, key, natural

    def _read(self, runs: list[int], schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*[f"{self.path}/run={n}" for n in runs])

    def read(self) -> DataFrame:
        """(natural..., key) of all runs."""
        return self._read(folder_numbers(self.spark, self.path, "run="))

    def extend(self, rows: DataFrame) -> DataFrame:
        """The map after numbering the natural keys of ``rows`` that it lacks. NULL is a natural key like any other."""
        runs = folder_numbers(self.spark, self.path, "run=")
        new, last = rows.select(*self.natural).distinct(), 0
        schema = T.StructType([*new.schema.fields, T.StructField(self.key, T.LongType())])  # known: no job to infer it
        if runs:
            known = self._read(runs, schema)
            last = known.agg(F.max(self.key)).first()[0] or 0
            had = known.select(*[F.col(c).alias(f"had_{c}") for c in self.natural])
            new = new.join(had, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"had_{c}")) for c in self.natural]), "left_anti")
            if new.isEmpty():
                return known
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        path = scratch_path(self.spark, "placed-keys")
        placed = new.repartitionByRange(*self.natural).sortWithinPartitions(*self.natural).select(
            *self.natural, F.spark_partition_id().alias("_part"), place.alias("_place"))
        placed.write.parquet(path)
        placed = self.spark.read.schema(placed.schema).parquet(path)
        before, offsets = last, {}
        for r in sorted(placed.groupBy("_part").count().collect()):  # one row per task
            offsets[r["_part"]] = before
            before += r["count"]
        if len(offsets) <= 256:
            placed = placed.withColumn("_before", F.create_map(*[F.lit(int(x)) for kv in offsets.items() for x in kv])[F.col("_part")]
                                       if offsets else F.lit(last))
        else:
            placed = placed.join(F.broadcast(self.spark.createDataFrame(list(offsets.items()), "_part int, _before long")), "_part")
        numbered = placed.select(*self.natural, (F.col("_before") + F.col("_place") + 1).alias(self.key))
        numbered.write.mode("overwrite").parquet(f"{self.path}/run={runs[-1] + 1 if runs else 1}")
        return self._read([*runs, runs[-1] + 1 if runs else 1], schema)

    def keyed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their key; unknown natural keys get a new one first."""
        known = self.extend(rows).select(F.col(self.key), *[F.col(c).alias(f"had_{c}") for c in self.natural])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"had_{c}")) for c in self.natural])
        return rows.join(known, same).drop(*[f"had_{c}" for c in self.natural])


def keyed(rows: DataFrame, key: str, natural: str, keys: KeyMap | None = None) -> DataFrame:
    """``rows`` with the number of their natural key, from ``keys`` or, without, from a map of their own."""
    keys = keys or KeyMap(rows.sparkSession, scratch_path(rows.sparkSession, f"keys-{key}"), key, natural)
    return keys.keyed(rows)
