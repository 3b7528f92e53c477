"""Exact deduplication by two-pass Bloom filtering.

Pass 1 hashes every text and keeps, per filter bit, whether two or more rows hit
it. Pass 2 tests every row: a row both of whose bits were hit twice may be
repeated and is shuffled by the SHA-256 of its text; all other rows are unique
for certain and pass straight through.

Two texts are equal when they are identical after each run of white space is
replaced by one space; NULL counts as empty. The filter only decides what is
shuffled, equality is decided by SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar.llm.common import SPACE, documents, unused_prefix, with_results

BITS_PER_ROW = 16
MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
SEGMENT_BITS = 1 << 18


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _positions(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bit of a hash in each of the two planes."""
    h = h.view(np.uint64)
    return [h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1) | np.uint64(bits)]


def repeated_bits(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of both planes: 1 where two or more rows hit the bit.

    A task sends each bit once, with a mark if it was hit twice there, so a
    text that a third of the rows share is sent once per batch. Reducers hold one
    segment each; only the finished bitmap (2 * ``bits`` / 8 bytes) reaches the driver."""
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False)
            if not len(h):
                continue
            at, n = np.unique(np.concatenate(_positions(h, bits)), return_counts=True)
            seg = at // SEGMENT_BITS
            cut = np.flatnonzero(np.diff(seg, prepend=-1))
            local = (at % SEGMENT_BITS).astype(np.uint32) | ((n > 1).astype(np.uint32) << np.uint32(31))
            yield pa.RecordBatch.from_arrays(
                [pa.array(seg[cut].astype(np.int32)),
                 pa.array([x.tobytes() for x in np.split(local, cut[1:])], pa.binary())], ["segment", "at"])

    def merged(table: pa.Table) -> pa.Table:
        once, twice = np.zeros(SEGMENT_BITS, dtype=bool), np.zeros(SEGMENT_BITS, dtype=bool)
        for x in table.column("at"):
            local = np.frombuffer(x.as_buffer(), dtype=np.uint32)
            at = local & np.uint32(0x7FFFFFFF)
            twice[at[once[at] | (local >> np.uint32(31)).astype(bool)]] = True
            once[at] = True
        return pa.table({"segment": table.column("segment")[:1],
                         "twice": pa.array([np.packbits(twice).tobytes()], pa.binary())})

    out = np.zeros(2 * bits // 8, dtype=np.uint8)
    step = SEGMENT_BITS // 8
    parts = (hashes.mapInArrow(sent, "segment int, at binary").groupBy("segment")
             .applyInArrow(merged, "segment int, twice binary"))
    for r in parts.toLocalIterator():
        out[r.segment * step:(r.segment + 1) * step] = np.frombuffer(r.twice, dtype=np.uint8)
    return out


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                     max_bits: int = MAX_BITS) -> DataFrame:
    """Every input row with ``text_sha256`` (of the normalised text), ``keep_id``
    (the smallest id of the group), ``group_size`` and ``kept``.

    Exactly one row of a group is kept: the smallest id, NULL ids last; of
    repeated rows with that id, the first of the scan. Input columns named like a
    result are replaced. An empty table gives an empty result.

    ``max_bits`` bounds the broadcast filter (2 * max_bits / 8 bytes: 64 MB).
    Beyond max_bits / 16 rows the filter fills up and more rows that are unique take
    the shuffled way; the result doesn't change."""
    spark = docs.sparkSession
    if not docs.columns or docs.isEmpty():
        bits = MIN_BITS
    else:
        bits = min(max_bits, max(MIN_BITS, 1 << (BITS_PER_ROW * docs.count() - 1).bit_length()))
    seen = spark.sparkContext.broadcast(
        repeated_bits(docs.select(F.xxhash64(normalised(F.col(f"`{text}`"))).alias("h")), bits))

    @F.pandas_udf("boolean")
    def maybe_repeated(h: pd.Series) -> pd.Series:
        a, b = _positions(h.to_numpy(), bits)
        hit = lambda p: (seen.value[p >> np.uint64(3)] >> (np.uint64(7) - (p & np.uint64(7))).astype(np.uint8)) & 1
        return pd.Series((hit(a) & hit(b)).astype(bool))

    own = unused_prefix(docs)
    norm, sha, h, row, maybe, first, n = (own + x for x in ("norm", "sha", "hash", "row", "maybe", "first", "n"))
    rows = (docs.withColumn(norm, normalised(F.col(f"`{text}`")))
            .withColumns({sha: F.sha2(norm, 256), h: F.xxhash64(norm), row: F.monotonically_increasing_id()}).drop(norm)
            .withColumn(maybe, maybe_repeated(h)).drop(h))
    single = with_results(rows.filter(~F.col(maybe)), {
        "text_sha256": F.col(sha), "keep_id": F.col(f"`{doc_id}`"),
        "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    several = rows.filter(maybe)
    least = several.groupBy(sha).agg(
        F.min(F.struct(F.col(f"`{doc_id}`").isNull().alias("n"), F.col(f"`{doc_id}`").alias("d"),
                       F.col(row).alias("r"))).alias(first), F.count("*").alias(n))
    joined = with_results(several.join(least, sha), {
        "text_sha256": F.col(sha), "keep_id": F.col(first)["d"], "group_size": F.col(n),
        "kept": F.col(row) == F.col(first)["r"]})
    return single.drop(sha, row, maybe).unionByName(joined.drop(sha, row, maybe, first, n))


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, MIN(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       COUNT(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = MIN(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM n"""
