"""Mixing sources to target weights with hash-threshold histograms.

Documents get a uniform 48-bit hash of their id. Per source, sizes are summed by
hash bucket; the bucket in which the budget runs out is the only one refined, by
the next 12 bits of the hash, until the threshold has all 48. A document is
taken (once more) if its hash lies below its source's threshold: a filter, no sort
of the documents.

Rows without an id, or with one that others bear, share that hash. Where the boundary is such a hash, its rows are
refined likewise by a hash of their texts and, where these agree too, by their row numbers: the threshold is
then a triple, compared part by part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servstar.llm.common import documents, unused_prefix, with_results, word_count, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
LEVEL_BITS = 12
#: Levels of each part of the threshold: 48 bits of the id's hash, 48 of the text's, 60 of the row number.
PARTS = {"hash": 4, "text_hash": 4, "row": 5}


def id_hash(doc_id):
    """48 bits of the MD5 of the id as text, as a long (NULL: of the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 12), 16, 10).cast("long")


def sizes_of(docs: DataFrame, text: str, source: str, doc_id: str) -> DataFrame:
    """(size, source, hash, text_hash, row) of each document."""
    t = F.col(f"`{text}`")
    return docs.select(word_count(t).alias("size"), F.col(f"`{source}`").alias("source"), *parts_of(t, F.col(f"`{doc_id}`")))


def parts_of(text, doc_id) -> list:
    """What thresholds compare. A row number is the partition's number and the row's there, 30 bits each."""
    row = F.monotonically_increasing_id()
    return [id_hash(doc_id).alias("hash"), F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 16).alias("text_hash"),
            (F.shiftright(row, 33) * (1 << 30) + row.bitwiseAND(F.lit((1 << 30) - 1))).alias("row")]


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target): ``share`` of all sizes divided by weight,
    each target at most ``most`` times its source's size, the excess reshared.

    The fixed point is target = min(most * size, weight * level); the sources at
    their bound are a prefix by size / weight, so the level follows from running
    sums. The windows hold one row per source, not per document."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = s.withColumn("w", w)
    up = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    every, before = Window.partitionBy(), up.rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("source_size").cast("double")
    s = s.withColumns({"total": F.sum(size).over(every) * share, "weight": F.sum("w").over(every),
                       "below": F.coalesce(F.sum(size).over(before), F.lit(0.0)),
                       "w_below": F.coalesce(F.sum("w").over(before), F.lit(0.0))})
    s = s.withColumn("full", most * size * (F.col("weight") - F.col("w_below"))
                     <= F.col("w") * (F.col("total") - most * F.col("below")))
    s = s.withColumns({"left": F.col("total") - most * F.sum(F.when(F.col("full"), size).otherwise(0.0)).over(every),
                       "w_left": F.sum(F.when(F.col("full"), F.lit(0.0)).otherwise(F.col("w"))).over(every)})
    return s.select("source", "source_size", F.when(F.col("full"), most * size).otherwise(
        F.col("w") * F.col("left") / F.nullif(F.col("w_left"), F.lit(0.0))).alias("target"))


def thresholds(rows: DataFrame, target: DataFrame) -> DataFrame:
    """(source, source_size, target, copies, at_hash, at_text_hash, at_row): every document of the
    source is taken ``copies`` times, those below the threshold once more. The last two parts are 0 where
    they don't matter.

    The last bucket (one row, or rows alike) is taken if that brings the source nearer to its target."""
    ratio = F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)).cast("double"))
    state = written(target, "targets").withColumn("copies", F.coalesce(ratio, F.lit(0)).cast("long")) \
        .withColumn("left", F.col("target") - F.col("copies") * F.col("source_size"))
    for part, levels in PARTS.items():
        state = refined(rows, state, part, levels)
        rows = rows.join(state.select(F.col("source").alias("s"), F.col(f"at_{part}").alias("at")),
                         F.col("source").eqNullSafe(F.col("s")) & (F.col(part) == F.col("at"))).drop("s", "at")
        if state.filter("several").isEmpty():
            break
    nearer = F.when(2 * F.col("left") >= F.col("last"), 1).otherwise(0)
    state = state.withColumn(f"at_{part}", F.col(f"at_{part}") + nearer)
    return state.select("source", "source_size", "target", "copies",
                        *[F.col(f"at_{p}") if f"at_{p}" in state.columns else F.lit(0).cast("long").alias(f"at_{p}") for p in PARTS])


def refined(rows: DataFrame, state: DataFrame, part: str, levels: int) -> DataFrame:
    """``state`` plus ``at_<part>``, the value of ``part`` in which the budget ``left`` runs out; ``left`` is what
    remains before it, ``last`` the size of its rows (NULL: the budget covers all), ``several`` whether it has more than one."""
    state = state.drop("last", "several").withColumn("prefix", F.lit(0).cast("long"))
    for level in range(levels):
        bucket = F.shiftright(part, LEVEL_BITS * (levels - 1 - level))
        inside = rows.join(state.select(F.col("source").alias("s"), "prefix"), F.col("source").eqNullSafe(F.col("s"))) \
            .filter(F.shiftright(bucket, LEVEL_BITS) == F.col("prefix"))
        hist = inside.groupBy("s", bucket.alias("bucket")).agg(F.sum("size").alias("n"), F.count("*").alias("rows"))
        over = Window.partitionBy("s").orderBy("bucket")
        hist = hist.withColumn("upto", F.sum("n").over(over))
        hist = hist.join(state.select(F.col("source").alias("k"), "left"), F.col("s").eqNullSafe(F.col("k")))
        edge = hist.filter(F.col("upto") > F.col("left")).groupBy("s").agg(
            F.min(F.struct("bucket", "n", "upto", "rows")).alias("e"))
        state = state.join(edge, F.col("source").eqNullSafe(F.col("s")), "left").withColumns({
            # no edge: the whole range fits (or is empty), so the threshold is its end
            "next": F.coalesce("e.bucket", F.shiftleft(F.col("prefix") + 1, LEVEL_BITS)),
            "left": F.col("left") - F.coalesce(F.col("e.upto") - F.col("e.n"), F.lit(0)),
            "last": F.col("e.n"), "several": F.coalesce(F.col("e.rows") > 1, F.lit(False))}) \
            .drop("prefix", "s", "e").withColumnRenamed("next", "prefix")
        state = written(state.drop("last", "several") if level < levels - 1 else state, "thresholds")  # one row per source
    return state.withColumnRenamed("prefix", f"at_{part}")


def taken_more(parts: list, at: list):
    """Whether the parts lie below the threshold."""
    below = F.lit(False)
    for p, t in reversed(list(zip(parts, at))):
        below = (p < t) | ((p == t) & below)
    return F.when(below, 1).otherwise(0)


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Every input row with ``size`` (words), ``source_size``, ``target``, ``copies``
    (how often the mix takes the document, 0 to ``most``) and ``taken`` = size * copies.

    Sources in code-point order, NULL last, weigh ``weights`` in turn. NULL or empty
    texts have size 0. A source's taken words miss its target by half a document at most, also where ids are NULL or repeated;
    which of several equal rows are taken goes by their place in the input, which should be read from storage. Same rows,
    same result. Input columns named like a result are replaced."""
    at = plan(written(sizes_of(docs, text, source, doc_id), "sizes"), weights, share, most)
    own = unused_prefix(docs)
    t = F.col(f"`{text}`")
    wide = docs.withColumns({own + "size": word_count(t)} | {own + p: c for p, c in zip(PARTS, parts_of(t, F.col(f"`{doc_id}`")))})
    out = with_results(*chosen(wide, at, own, f"`{source}`"))
    return out.select(*[F.col(f"`{c}`") for c in out.columns if not c.startswith(own)])


def plan(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    return written(thresholds(rows, targets(rows, weights, share, most)), "thresholds")


def chosen(rows: DataFrame, at: DataFrame, own: str, source: str) -> tuple[DataFrame, dict]:
    """Rows with columns size, hash, text_hash and row under the prefix ``own``, joined to their source's
    threshold, and the results."""
    at = at.toDF(*[f"{own}for_{c}" for c in at.columns])
    col = lambda c: F.col(own + c)
    wide = rows.join(at, F.col(source).eqNullSafe(col("for_source")))
    copies = col("for_copies") + taken_more([col(p) for p in PARTS], [col(f"for_at_{p}") for p in PARTS])
    return wide, {"size": col("size"), "source_size": col("for_source_size"), "target": col("for_target"), "copies": copies,
                  "taken": col("size") * copies}


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix over (doc_id, size, source, hashes) only, so that the texts are read and their words counted once."""
    docs = documents(spark, sf_dir)
    ids = F.col("doc_id")
    rows = written(docs.select("doc_id", word_count(F.col("text")).alias("size"), "source", *parts_of(F.col("text"), ids)), "sizes")
    wide, results = chosen(rows.withColumnsRenamed({c: f"_{c}" for c in ("size", *PARTS)}), plan(rows), "_", "source")
    return wide.select("doc_id", *[results[c].alias(c) for c in ("size", "source_size", "target", "taken")])


#: By sorting, where the operator filters by threshold.
ORACLE = r"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS hash
    FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
             CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS w
      FROM d GROUP BY source),
r AS (SELECT *, CAST(SUM(source_size) OVER () AS DOUBLE) * 1.5 AS total, SUM(w) OVER () AS weight,
             coalesce(CAST(SUM(source_size) OVER up AS DOUBLE), 0) AS below, coalesce(SUM(w) OVER up, 0) AS w_below
      FROM s WINDOW up AS (ORDER BY source_size / w, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, 2 * source_size * (weight - w_below) <= w * (total - 2 * below) AS is_full FROM r),
l AS (SELECT *, total - 2 * CAST(SUM(CASE WHEN is_full THEN source_size ELSE 0 END) OVER () AS DOUBLE) AS rest,
             SUM(CASE WHEN is_full THEN 0 ELSE w END) OVER () AS w_rest FROM f),
t AS (SELECT source, source_size,
             CASE WHEN is_full THEN 2.0 * source_size ELSE w * rest / w_rest END::DOUBLE AS target FROM l),
b AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS copies FROM t),
c AS (SELECT d.*, source_size, target, copies, target - copies * source_size AS budget,
             SUM(size) OVER (PARTITION BY d.source ORDER BY hash RANGE UNBOUNDED PRECEDING) AS upto,
             SUM(size) OVER (PARTITION BY d.source, hash) AS own
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (copies + CASE WHEN upto <= budget OR (upto - own <= budget AND 2 * (budget - (upto - own)) >= own)
                                  THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c"""
