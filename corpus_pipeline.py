"""Corpus pipeline: toxic documents out, one document of each near-duplicate group, benchmark passages out, mix, shards.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; all but the last return the columns of documents. ``run`` writes each
stage's result to the shared folder and reads it back for the next.

Results for odd input, besides what the operators say: documents without words
are nobody's duplicate and stay until the mix, which takes no words from them;
of repeated rows of one document one stays; the mix repeats a row once for each
epoch that takes it; columns that documents have besides the usual ones are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm import decontamination, mixing, partenum, sharding, toxicity
from salesmart.llm.common import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, teaches=~toxicity.held_out(F.col("doc_id")))
    return toxicity.score(docs, model).where(F.col("score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups, _ = partenum.similar_groups(docs)
    keys = ("_id", "_hash")
    first = staged(
        groups.where("is_first").groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.count("*").alias("rows"), F.max("n_shingles").alias("size")),
        "firsts",
    )
    hashed = docs.select("*", F.col("doc_id").alias("_i"), F.xxhash64("text").alias("_h"))
    same = F.col("_i").eqNullSafe(F.col("_id")) & F.col("_h").eqNullSafe(F.col("_hash"))
    kept = hashed.join(first.select(*keys), same, "left_semi")
    repeated = first.where("rows > 1 and size > 0").select(*keys)
    if not repeated.isEmpty():
        once = kept.join(repeated, same, "left_semi").dropDuplicates(["_i", "_h"])
        kept = kept.join(repeated, same, "left_anti").union(once)
    return kept.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.flag(docs, benchmark).where(F.size("leaks") == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.withColumn("_k", F.xxhash64("doc_id", "text"))
    mixed = staged(
        mixing.mix(keyed, key="_k").where(F.size("positions") > 0).select(F.col("_k").alias("_m"), "positions", "place"), "mixed"
    )
    repeated = staged(mixed.groupBy(F.col("_m").alias("_r")).agg(F.count("*").alias("n")).where("n > 1").select("_r"), "repeated")
    taken = keyed.join(mixed, F.col("_k") == F.col("_m"))
    if not repeated.isEmpty():
        # repeated rows have places of their own: the nth row gets the nth place
        nth = Window.partitionBy("_k").orderBy("_k")
        rows = keyed.join(repeated, F.col("_k") == F.col("_r"), "left_semi").withColumn("_n", F.row_number().over(nth))
        places = mixed.join(repeated, F.col("_m") == F.col("_r"), "left_semi").withColumn(
            "_o", F.row_number().over(Window.partitionBy("_m").orderBy("positions"))
        )
        again = rows.join(places, (F.col("_k") == F.col("_m")) & (F.col("_n") == F.col("_o")))
        single = taken.join(repeated, F.col("_k") == F.col("_r"), "left_anti")
        taken = single.select(*docs.columns, "positions", "place").union(again.select(*docs.columns, "positions", "place"))
    return mixing.training_stream(taken).select(*docs.columns)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Most stages have no SQL; tests hold the rows of ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
