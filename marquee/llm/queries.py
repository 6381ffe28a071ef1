"""The queries op1_ to op13_ and pipeline, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import annulus, hidden, langid, mixing, mtree, packing, quality, recompress, secrets, simhash, suffixes, toxicity, turns
from marquee.llm.common import documents


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), digest=True)


def op2_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.dedup(documents(spark, sf_dir))


def op3_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(documents(spark, sf_dir))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.amounts(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op12_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden.score(documents(spark, sf_dir))


def op13_annulus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annulus.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_recompression": op2_recompression,
    "op3_mtree": op3_mtree,
    "op4_simhash": op4_simhash,
    "op5_language": op5_language,
    "op6_suffixes": op6_suffixes,
    "op7_quality": op7_quality,
    "op8_secrets": op8_secrets,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_turns": op11_turns,
    "op12_hidden_markov": op12_hidden_markov,
    "op13_annulus": op13_annulus,
    "pipeline": pipeline,
}
ORACLES = {"op3_mtree": mtree.ORACLE, "op8_secrets": secrets.ORACLE, "op9_mixing": mixing.ORACLE, "op11_turns": turns.ORACLE, "op13_annulus": annulus.ORACLE}
