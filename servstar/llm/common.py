"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servstar.session import scratch_path

#: The white space of the operators' word rules, as a Java/Python character class.
SPACE = r"[\x20\x09-\x0D]+"
#: Text bytes handled at once inside a task; bounds numpy's working memory.
CHUNK_BYTES = 1 << 21
#: Shuffle files of a finished job go at once instead of with the driver's next garbage collection.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back:
    cuts the lineage, survives the loss of any executor, and lets the shuffle
    files behind it go before the next step starts."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def with_results(df: DataFrame, results: dict) -> DataFrame:
    """``df`` plus the result columns; an input column that bears a result's
    name is replaced."""
    taken = {k.lower() for k in results}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[c.alias(k) for k, c in results.items()])


def unused_prefix(df: DataFrame) -> str:
    """Underscores that no column name of ``df`` starts with: a name after them is free."""
    return "_" * (1 + max([2, *[len(c) - len(c.lstrip("_")) for c in df.columns]]))


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(did, t32, text, doc_id): ``did`` is the id, or for a NULL id a number above 2**62
    made from the text, so NULL ids come last and apart; ``t32`` tells rows that share an id but not a text."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    late = F.lit((1 << 63) - 1) - F.xxhash64(t).bitwiseAND(F.lit((1 << 62) - 1))
    return docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), late).alias("did"), F.hash(t).alias("t32"),
                       t.alias("text"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"))


def hash_sample(df: DataFrame, rows: int, *columns) -> DataFrame:
    """About ``rows`` rows (all, if there are fewer): those with the smallest hashes of
    ``columns``. A filter, so nothing is gathered; the same rows each time."""
    total = df.count()
    if total <= rows:
        return df
    return df.filter(F.xxhash64(*columns) < F.lit(int(rows / total * (1 << 64)) - (1 << 63)))


def word_count(text):
    """Number of maximal runs of non-space characters (NULL: 0)."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))
    return F.when(t == "", F.lit(0)).otherwise(
        F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("long")


# -- whole texts as byte buffers ------------------------------------------------------------

def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about
    ``chunk_bytes``; a longer text is a chunk of its own. NULL is empty."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64,
                            count=len(column) + column.offset + 1)[column.offset:]
    data = (np.frombuffer(column.buffers()[2], dtype=np.uint8)
            if column.buffers()[2] is not None else np.zeros(0, dtype=np.uint8))
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + chunk_bytes, side="right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of concatenated texts, and the text of each."""
    if not len(data):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    word = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class RollingHash:
    """64-bit polynomial hashes of spans by prefix sums (arithmetic modulo 2**64,
    a random odd base and random byte values). Two seeds give 128 bits."""

    def __init__(self, seed: int):
        self.values = _odd(seed, 256)
        self.base = _odd(seed + 1, 1)[0]
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        one = np.ones(1, dtype=np.uint64)
        self.up = np.concatenate([one, np.cumprod(np.full(n, self.base))])
        self.down = np.concatenate([one, np.cumprod(np.full(n, self.inverse))])

    def prefix(self, values: np.ndarray) -> np.ndarray:
        if len(values) >= len(self.up):
            self._grow(2 * len(values))
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[:len(values)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts, ends) -> np.ndarray:
        return mixed((prefix[ends] - prefix[starts]) * self.down[starts])

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each span of bytes, a block of spans at a time."""
        out = np.empty(len(starts), dtype=np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + (CHUNK_BYTES >> 1), side="right")))
            a = starts[i]
            p = self.prefix(self.values[data[a:ends[j - 1]]])
            out[i:j] = self.spans(p, starts[i:j] - a, ends[i:j] - a)
            i = j
        return out

    def windows(self, values: np.ndarray, size: int) -> np.ndarray:
        """Hash of each run of ``size`` consecutive values."""
        n = len(values) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        at = np.arange(n)
        return self.spans(self.prefix(values), at, at + size)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


# -- connected components -------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, component) of undirected long edges (u, v): component is the
    smallest node reachable. Nodes without edges don't appear.

    Alternating large-star and small-star steps (Kiveris et al. 2014): every
    step is a minimum per node with map-side combining and a join on the node,
    so a hub is split by AQE's skew join. Each round is a written table; the
    rounds grow with the logarithm of the longest path."""
    edge = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
        .filter("u <> v").distinct()
    edge, last = written(edge, "edges"), None
    while True:
        sign = tuple(edge.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if sign == last or not sign[0]:
            return edge.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edge.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        last = sign
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edge = written(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")


def least_of(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component_id) of ``components``: the smallest ``least`` of its ``nodes`` (node, least), NULL where all are."""
    found = written(found.join(nodes, "node"), "component-nodes")
    least = found.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.select("node", "component").join(least, "component").select("node", "component_id")
