"""Sharding along a Hilbert curve, with DataFrame functions only.

Several metadata dimensions are quantised by their corpus-wide quantiles, rows are
sorted by the index of their cell on the Hilbert curve, and the sorted run is
cut into shards of equal row counts. Neighbours on the curve are neighbours in
every dimension, so a shard's minimum and maximum of each dimension prune files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servstar.llm.common import documents, written

SHARDS = 24
BITS = 6
_ROW_MASK = (1 << 33) - 1


def curve_tables(dims: int) -> tuple[list[int], list[int], list[int]]:
    """Digit and next state (entry corner, direction) of one level of the curve,
    by state * 2**dims + orthant (Hamilton's recurrences on Gray codes)."""
    n, size = dims, 1 << dims
    gray = [i ^ (i >> 1) for i in range(size)]
    rank = {g: i for i, g in enumerate(gray)}
    trailing = lambda i: (~i & (i + 1)).bit_length() - 1  # noqa: E731  number of trailing ones
    rotl = lambda x, k: ((x << (k % n)) | (x >> (n - k % n))) & (size - 1)
    rotr = lambda x, k: rotl(x, n - k % n)
    entry = lambda i: 0 if i == 0 else gray[2 * ((i - 1) // 2)]
    turn = lambda i: 0 if i == 0 else trailing(i - 1) % n if i % 2 == 0 else trailing(i) % n
    digit, corner, direction = [], [], []
    for e in range(size):
        for d in range(n):
            for orthant in range(size):
                i = rank[rotr(orthant ^ e, d + 1)]
                digit.append(i)
                corner.append(e ^ rotl(entry(i), d + 1))
                direction.append((d + turn(i) + 1) % n)
    return digit, corner, direction


def hilbert_index(cells: list, bits: int = BITS):
    """Index on the curve of a cell given by integer columns of ``bits`` bits."""
    n, size = len(cells), 1 << len(cells)
    digit, corner, direction = (F.array(*[F.lit(x) for x in t]) for t in curve_tables(n))
    levels = F.array(*[F.struct(*[F.shiftright(c.cast("int"), b).bitwiseAND(F.lit(1)).alias(f"x{k}")
                                  for k, c in enumerate(cells)]) for b in range(bits - 1, -1, -1)])

    def level(acc, x):
        orthant = sum((F.shiftleft(x[f"x{k}"], k) for k in range(1, n)), x["x0"])
        at = (acc["e"] * n + acc["d"]) * size + orthant + 1
        return F.struct(F.element_at(corner, at).alias("e"), F.element_at(direction, at).alias("d"),
                        (F.shiftleft(acc["h"], n) + F.element_at(digit, at)).alias("h"))

    start = F.struct(F.lit(0).alias("e"), F.lit(0).alias("d"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(levels, start, level, lambda acc: acc["h"])


def string_cuts(values: DataFrame, cells: int) -> list[str]:
    """The values of the string column ``v`` that end each of the first ``cells`` - 1 equal parts of the sorted rows;
    a frequent value ends several.

    Equal values are counted first, the running counts are those of sorted partitions of distinct
    values, and the driver gets at most ``cells`` of them."""
    counts = values.groupBy("v").agg(F.count("*").alias("n"))
    run = written(counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "hilbert-values")
    sums = run.groupBy("part").agg(F.sum("n").alias("rows"))
    # One row per partition of the distinct values.
    offsets = sums.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("skip"),
                          F.sum("rows").over(Window.partitionBy()).alias("total"))
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    ends = run.withColumn("upto", upto).join(offsets, "part").select(
        "v", F.expr(f"(skip + upto - n) * {cells} div total").alias("first"),
        F.expr(f"least((skip + upto) * {cells} div total, {cells - 1})").alias("last"))
    return [r.v for r in sorted(ends.filter("first < last").collect(), key=lambda r: r["first"])
            for _ in range(r["last"] - r["first"])]


def hilbert_shards(docs: DataFrame, dims: list[str], text: str = "text", doc_id: str = "doc_id",
                   shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, hilbert, law, shard, slot, grown_shard) of every row.

    Law ``rows``: the curve is cut into ``shards`` runs whose row counts differ by
    at most one; ``slot`` numbers a shard's rows from 0. Ties on the curve are ordered
    by text hash (equal texts of one cell stay together), then id; a cell that holds a third of
    all rows is therefore cut like any other. NULL text: size 8, CRC of
    nothing. NULL metadata sort first. ``dims``: two to four columns; strings are
    quantised as whole values, others as integers.

    One range shuffle of narrow rows; row numbers come from the sorted
    partitions and their counts, not from a window over all rows."""
    kinds = dict(docs.dtypes)
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(t) + 8).cast("long").alias("size"),
        F.crc32(F.encode(t, "UTF-8")).alias("text_crc32"), F.xxhash64(t).alias("th"),
        *[(F.coalesce(F.col(f"`{c}`"), F.lit("")) if kinds[c] == "string" else F.coalesce(F.col(f"`{c}`").cast("long"), F.lit(0)))
          .alias(f"x{k}") for k, c in enumerate(dims)])
    kind = ["string" if kinds[c] == "string" else "long" for c in dims]
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [k for k in range(len(dims)) if kind[k] == "long"]
    quantiles = dict(zip(numbers, narrow.agg(*[F.percentile_approx(f"x{k}", cuts, 10000) for k in numbers]).first())) if numbers else {}
    quantiles |= {k: string_cuts(narrow.select(F.col(f"x{k}").alias("v")), 1 << bits)
                  for k in range(len(dims)) if kind[k] == "string"}

    def cell(k: int):
        bounds = F.array(*[F.lit(q) for q in quantiles[k] or []]).cast(f"array<{kind[k]}>")
        return F.size(F.filter(bounds, lambda q: q < F.col(f"x{k}")))

    placed = narrow.select("doc_id", "size", "text_crc32", "th",
                           hilbert_index([cell(k) for k in range(len(dims))], bits).alias("hilbert"))
    order = ["hilbert", "th", "doc_id"]
    run = written(placed.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("at", F.monotonically_increasing_id()), "hilbert-run")
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit(_ROW_MASK))
    counts = run.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row per partition of the sorted run.
    offsets = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("skip"),
                            F.sum("n").over(Window.partitionBy()).alias("total"))
    ranked = run.withColumns({"part": part, "row": row}).join(offsets, "part").withColumn(
        "rank", F.col("skip") + F.col("row"))
    shard = F.expr(f"rank * {shards} div total")
    ranked = ranked.withColumn("shard", shard.cast("int"))
    first = F.expr(f"(cast(shard as bigint) * total + {shards - 1}) div {shards}")
    return ranked.select("doc_id", "size", "text_crc32", "hilbert", F.lit("rows").alias("law"), "shard",
                         (F.col("rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_hilbert_sharding(spark, sf_dir: str) -> DataFrame:
    return hilbert_shards(documents(spark, sf_dir), ["source", "lang", "n_chars"])
