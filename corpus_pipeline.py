"""The corpus pipeline: documents are classified, deduplicated, mixed and packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's
result under ``spark.checkpoint.dir`` and reads it back as the next one's documents. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar.llm import exact_dedup, mixing, packing, quality, simhash
from servstar.llm.common import documents, written


def quality_classifier(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise-ranked classifier predicts good."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(quality.predicted(quality.scored(F.col("text"), model)) == 1)


def inside(docs: DataFrame) -> DataFrame:
    """The documents under other column names, so that none can clash with an operator's results."""
    return docs.toDF(*[f"in_{c}" for c in docs.columns])


def outside(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"`in_{c}`").alias(c) for c in docs.columns])


def exact(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    return outside(exact_dedup.exact_duplicates(inside(docs), "in_text", "in_doc_id").filter("kept"), docs)


def near(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id (NULL last) and text, of each group of near-duplicates. Rows equal in id and text
    stay or go together."""
    gone = simhash.near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("gone_id"), "text_hash").distinct()
    rows = inside(docs)
    same = F.col("in_doc_id").cast("long").eqNullSafe(F.col("gone_id")) & (simhash.text_hash(F.col("in_text")) == F.col("text_hash"))
    return outside(rows.join(gone, same, "left_anti"), docs)


def mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    mixed = mixing.mix(inside(docs), "in_text", "in_source", "in_doc_id").filter("copies > 0")
    return outside(mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))), docs)


def pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 ids."""
    return packing.digest(packing.pack(docs, packing.tokenizer_file()))


STAGES = [("quality classifier", quality_classifier), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("mixing", mix), ("packing", pack)]

#: Fingerprints, classifier and tokenizer have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
