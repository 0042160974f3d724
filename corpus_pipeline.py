"""Corpus pipeline: filter, de-duplicate, decontaminate, redact and tokenise documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. A caller may
write each stage's result as Parquet and read it back as the next one's docs;
``run`` does so in the shared checkpoint folder. Rows are told apart by id and text
hash, not by id alone, so rows without an id and rows that share one are decided
by their own text; all but the last stage return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowguard.llm import decontaminate, minhash, secrets, sentencepiece_codec, toxicity
from rowguard.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of these documents, does not reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), mod=5))


#: ids of rows without one, in a range beyond all others: copies that have an id stay before them
NAMELESS = 1 << 62


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8.

    Rows of equal id and text are one document too: one of them stays. Texts
    without words are no copies of anything, except of their own row.
    """
    text = F.col("text").cast("string")
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NAMELESS) + F.shiftright(F.xxhash64(text), 2))
    rows = docs.select(F.struct(*docs.columns).alias("row"), own.alias("k"), F.xxhash64(text).alias("h"), text.alias("t"))
    named = rows.select(F.col("k").alias("doc_id"), F.col("t").alias("text"))
    gone = minhash.near_duplicates(named, size=5, percent=80).filter("NOT kept").select(F.col("doc_id").alias("k"), F.col("text_hash").alias("h"))
    left = rows.join(gone, ["k", "h"], "left_anti")
    # rows that repeat: counted by key alone, so no text moves for them, and only they meet
    repeated = staged(rows.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k", "h"), "repeated")
    once = left.join(repeated, ["k", "h"], "left_anti").select("row.*")
    if repeated.isEmpty():
        return once
    again = left.join(repeated, ["k", "h"], "left_semi").groupBy("k", "h").agg(F.first("row").alias("row"))
    return once.unionByName(again.select("row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    found = found.filter(F.col("n_hit") > 0).select("doc_id", "text_hash").distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(found["doc_id"]) & (F.xxhash64(docs["text"].cast("string")) == found["text_hash"])
    return docs.join(found, same, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by the name of their kind; all documents stay."""
    return secrets.redact(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every remaining text, with the proof that they decode to it."""
    return sentencepiece_codec.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontaminate", drop_contaminated),
    ("secrets", redact_secrets),
    ("sentencepiece", tokenise),
]

#: no SQL: a learned classifier, MinHash and SentencePiece are among the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
