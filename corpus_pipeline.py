"""From raw documents to packed token sequences.

Each stage takes all documents its predecessor kept and returns those that stay, with the columns of ``documents``; the
last one returns packed pieces. ``run`` stores every stage's result in the shared folder before the next one reads it.
Repeated, empty and null texts and null ids pass through every stage; an empty table gives an empty result. Further columns
of any name and type are kept as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import ledgerflow.llm.common as common
import ledgerflow.llm.contamination as contamination
import ledgerflow.llm.packing as packing
import ledgerflow.llm.quality as quality
import ledgerflow.llm.repeats as repeats
import ledgerflow.llm.simhash as simhash
from ledgerflow.settings import ship


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, scores 0.5 or more."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    inner, back = common.aside(docs, "doc_id", "text")
    return back(quality.with_score(inner, model, "score").filter("score >= 0.5"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates one row: that with the smallest id, of rows with one id that with the smallest hash.

    Rows stand for themselves, not for their ids: rows with one id and different texts stay or go each with its own group.
    """
    inner, back = common.aside(docs, "doc_id", "text")
    # Ids made from texts come after all real ones.
    own = F.coalesce("doc_id", F.lit(1 << 62) + F.xxhash64("text").bitwiseAND((1 << 61) - 1))
    plain = (T.StringType, T.NumericType, T.BooleanType, T.BinaryType, T.DatetimeType)
    values = [F.col(f.name) if isinstance(f.dataType, plain) else F.to_json(F.struct(f.name)) for f in inner.schema.fields]
    keyed = inner.withColumns({"own": own, "row": F.xxhash64(*[F.col(c).isNull() for c in inner.columns], *values)})
    first = common.store(simhash.first_rows(keyed, ["own", "row"]), "near-duplicates")
    kept = keyed.join(first, ["own", "row"], "left_semi")
    if not first.filter("rows > 1").isEmpty():
        kept = kept.dropDuplicates(["own", "row"])
    return back(kept)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 200 bytes and more that occur twice; a character goes when any byte of it goes."""
    inner, back = common.aside(docs, "doc_id", "text", "n_chars")
    cut = repeats.remove_repeats(inner, least=200, whole_characters=True)
    text = F.when(F.col("text").isNotNull(), F.col("_cut.kept").cast("string"))
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long"))
    return back(cut.withColumns({"text": text, "n_chars": n_chars}))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in sequences of at most 1024."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmarks),
    ("best-fit packing", packed),
]

# Fitted models, fingerprints and tokenizers are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir.rstrip("/"))
        if n + 1 < len(STAGES):
            docs = common.store(docs, "stage")
    return docs
