"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension (rows) we hint as broadcast. Dimensions here are bounded by
# their domains (nations, part types x priorities, calendar days), far below this.
MAX_BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                       known_rows: int | None = None) -> DataFrame:
    """Broadcast-hint ``df`` only when it has at most ``max_rows`` rows.

    ``known_rows`` (e.g. recorded when the table was written) avoids a job;
    otherwise a bounded ``limit(max_rows + 1).count()`` decides, which reads at
    most ``max_rows + 1`` rows. Above the bound the join is left to the planner
    (sort-merge, with AQE skew handling).
    """
    n = known_rows if known_rows is not None else df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
