"""Queries op1..op13 on the test tables, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowguard.llm import alignment as op12
from rowguard.llm import chat as op8
from rowguard.llm import decontaminate as op10
from rowguard.llm import language_id as op9
from rowguard.llm import lm_scoring as op3
from rowguard.llm import merkle as op4
from rowguard.llm import minhash as op6
from rowguard.llm import ranked_search as op13
from rowguard.llm import secrets as op2
from rowguard.llm import sentencepiece_codec as op1
from rowguard.llm import token_files as op11
from rowguard.llm import toxicity as op5
from rowguard.llm import warc as op7
from rowguard.llm.common import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document text, decoded again."""
    return op1.encode(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every whole document text, with ownership classes."""
    found = op2.scan(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*op2.BASE))
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(op2.listed(base), 256).alias("base_sha256"),
                        op2.listed(F.col("spans")).alias("spans"), "n_example", "n_live")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all texts under the backoff automaton of the training texts."""
    return op3.score(table(spark, sf_dir, "documents"), mod=10)


def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and of their edited texts."""
    return op4.fingerprints(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return op5.score(docs, op5.fit(docs, table(spark, sf_dir, "labels"), mod=5), mod=5)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, 80 percent."""
    return op6.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80).drop("text_hash")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    found = op7.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that holds control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    out = op8.conversations(op8.chain(turns.union(extra)))
    out = out.withColumn("turns", op8.parse(F.col("formatted"))).withColumn("loss", op8.masked(F.col("formatted"), F.col("loss_spans")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return op9.identify(docs, op9.fit(docs, mod=5), mod=5)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 10-word windows of benchmark items."""
    found = op10.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, written as binary files and read back."""
    back = op11.round_trip(table(spark, sf_dir, "documents"))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned at their common byte ends, for every whole text."""
    told = op12.align(table(spark, sf_dir, "documents"))
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return told.withColumn("groups_sha256", sha).drop("groups")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return op13.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_secrets": op2_secrets,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_merkle": op4_merkle,
    "op5_toxicity": op5_toxicity,
    "op6_minhash": op6_minhash,
    "op7_warc": op7_warc,
    "op8_chat": op8_chat,
    "op9_language_id": op9_language_id,
    "op10_decontaminate": op10_decontaminate,
    "op11_token_files": op11_token_files,
    "op12_alignment": op12_alignment,
    "op13_ranked_search": op13_ranked_search,
}

#: The other queries have no SQL: a model, a signature or a tree decides, or the
#: regular expression positions differ by engine; tests hold them against plain
#: Python versions (tests/llm/brute.py).
ORACLE: dict[str, str] = {
    "op7_warc": """
        WITH p AS (SELECT page_id, encode(COALESCE(html, '')) AS b FROM pages),
        q AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS d FROM p),
        r AS (SELECT *, CASE WHEN n >= 1000 THEN MAX(page_id) OVER (PARTITION BY d) ELSE page_id END AS newest FROM q)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
          CASE WHEN newest = page_id THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN newest <> page_id THEN newest END AS refers_to, TRUE AS verified FROM r""",
    "op8_chat": r"""
        WITH t AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, CASE role WHEN 'user' THEN 'INST' WHEN 'system' THEN 'SYS' WHEN 'assistant' THEN 'ANS'
            ELSE 'ROLE ' || replace(replace(replace(replace(role, '%', '%25'), '[', '%5B'), ']', '%5D'), '<', '%3C') END AS tag,
          regexp_replace(text, '(<|\[)(\\*)(/?s>|/?(?:INST|SYS|ANS|ROLE))', '\1\2\\\3', 'g') AS body FROM t),
        g AS (SELECT conv_id, COUNT(*) AS n_turns,
          string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
          COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
          SUM(15 + length(tag) + length(body) + length(split_part(tag, ' ', 1))) AS chars FROM e GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
          CAST(chars AS BIGINT) AS formatted_chars FROM g""",
    "op13_ranked_search": r"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        c AS (SELECT k, doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0),
        s AS (SELECT COUNT(*) AS nn, CAST(SUM(n) AS BIGINT) AS ll FROM c),
        i AS (SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, COALESCE(text, '') AS text FROM benchmark)),
        q AS (SELECT item_id, text, term, COUNT(*) AS often FROM i GROUP BY ALL),
        p AS (SELECT k, doc_id, n, term, COUNT(*) AS tf FROM (SELECT k, doc_id, n, unnest(terms) AS term FROM c)
            WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, nn),
        r AS (SELECT item_id, text, k, doc_id,
            SUM(often * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll)))) AS score
            FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL),
        o AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id, k) AS rank FROM r WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 10""",
}
