"""Operator 2: secret scan with corpus-wide ownership frequency (DataFrame functions only).

Candidates are found with regular expressions on whole texts; ``split`` by a
pattern and ``regexp_extract_all`` of it give gaps and matches in turn, whose
running lengths are the code-point spans. What a single text cannot tell, the
corpus can: candidate hashes are aggregated by distinct repositories and owners.
A value that many owners carry is a copied example; a value that one owner
holds, and that looks random, is a live-looking credential.

Kinds: ``assign``, ``access`` and ``hex`` are the base and always stay in the
result. ``generic`` spans (long mixed-case strings with digits) are too common
in harmless text to report alone; ownership decides, and only owner-specific,
live-looking ones are added.

Shuffles: candidates only, never texts. Values are hashed in the scan;
(hash, owner) pairs are pre-aggregated before owners are counted, and the class
table is joined to the candidates by hash, a join that adaptive execution can
split when one hash is hot.

Defined results: null or empty text has no spans; a null owner or repository
counts as one unnamed owner or repository; rows that repeat a document repeat
its result, each row on its own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import staged

KEYWORDS = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = f"({KEYWORDS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: in the order in which spans with one start are listed: name, pattern, group
#: that is the value. A run that is too short for the two middle kinds can hold
#: no longer one, so their lower bounds are part of the patterns.
KINDS = (
    ("assign", ASSIGN, 2),
    ("access", "AKIA[A-Z0-9]{16,}", 0),
    ("hex", "[0-9a-f]{24,}", 0),
    ("generic", "[A-Za-z0-9_-]{32,}", 0),
)
BASE = ("assign", "access", "hex")
MIN_ASSIGN = 6
#: a value held by this many owners is a copied example
EXAMPLE_OWNERS = 3


#: lengths that are summed at a time
STEP = 64


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _before(lengths: Column) -> Column:
    """Sum of all earlier lengths, for each: sums of steps first, so that a text with
    many matches takes about its length in time, not the square."""
    def of(n: Column) -> Column:
        steps = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(n) / STEP).cast("int") - 1, F.lit(0)))
        sums = F.transform(steps, lambda b: _total(F.slice(n, b * STEP + 1, STEP)))
        upto = lambda t: F.transform(t, lambda _, b: _total(F.slice(t, F.lit(1), b)))
        return _let(_let(sums, upto), lambda t: F.transform(n, lambda _, i: F.element_at(
            t, (i / STEP).cast("int") + 1) + _total(F.slice(n, i - i % STEP + 1, i % STEP))))

    return _let(lengths, of)


def _spans(gaps: Column, hits: Column, kind: str, rank: int, value: Column) -> Column:
    """Array of (start, rank, kind, end, value) from gaps and matches in turn."""
    glen, hlen = F.transform(gaps, F.length), F.transform(hits, F.length)
    parts = F.struct(hits.alias("hit"), value.alias("value"), glen.alias("g"), hlen.alias("h"), _before(glen).alias("gs"), _before(hlen).alias("hs"))

    def of(p: Column) -> Column:
        def span(_: Column, i: Column) -> Column:
            start = p["gs"][i] + p["g"][i] + p["hs"][i]
            return F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                            (start + p["h"][i]).alias("end"), p["value"][i].alias("value"))

        return F.transform(p["hit"], span)

    return _let(parts, of)


def _random_looking(value: Column) -> Column:
    """Lower and upper case and digits, or hex digits of both sorts; few repeats."""
    mixed = value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]")
    hexes = value.rlike("^[0-9a-f]+$") & value.rlike("[0-9]") & value.rlike("[a-f]")
    plain = value.rlike("[A-Za-z]") & value.rlike("[0-9]")
    distinct = F.size(F.array_distinct(F.split(value, "")))
    example = F.lower(value).rlike("example|sample|dummy|changeme|placeholder|x{4}|1234567|abcdef")
    return (mixed | hexes | (plain & (F.length(value) <= 40))) & (distinct >= 6) & ~example


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str | None = "source",
         repo_col: str | None = None) -> DataFrame:
    """One row per row: doc_id, text_hash, owner, repo, spans (all candidates, in order)."""
    doc_id = F.col(id_col).cast("long")
    owner = F.col(owner_col).cast("string") if owner_col else F.lit(None).cast("string")
    repo = F.col(repo_col).cast("string") if repo_col else doc_id.cast("string")
    df = docs.select(doc_id.alias("doc_id"), F.coalesce(owner, F.lit("")).alias("owner"),
                     F.coalesce(repo, F.lit("")).alias("repo"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    for name, pattern, _ in KINDS:
        df = df.withColumn(f"gaps_{name}", F.when(F.col("text").rlike(pattern), F.split("text", pattern, -1)))
    for name, pattern, group in KINDS:
        found = F.col(f"gaps_{name}").isNotNull()
        df = df.withColumn(f"hits_{name}", F.when(found, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
        if group:
            df = df.withColumn(f"values_{name}", F.when(found, F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).otherwise(none))
    parts = []
    for rank, (name, _, group) in enumerate(KINDS):
        spans = _spans(F.coalesce(f"gaps_{name}", none), F.col(f"hits_{name}"), name, rank,
                       F.col(f"values_{name}" if group else f"hits_{name}"))
        if name == "assign":
            spans = F.filter(spans, lambda s: F.length(s["value"]) >= MIN_ASSIGN)
        if name == "generic":
            spans = F.filter(spans, lambda s: _random_looking(s["value"]) & s["value"].rlike("[a-z]")
                             & s["value"].rlike("[A-Z]") & s["value"].rlike("[0-9]"))
        parts.append(spans)
    spans = F.transform(F.array_sort(F.concat(*parts)), lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"),
        F.sha2(s["value"], 256).alias("hash"), _random_looking(s["value"]).alias("random")))
    return df.select("doc_id", F.xxhash64("text").alias("text_hash"), "owner", "repo", spans.alias("spans"))


def ownership(candidates: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """Per value hash: n_repos, n_owners, ownership ('example' or 'specific').

    Distinct repositories and owners are counted over pre-aggregated pairs: a hash
    that a third of all rows carry is one row per owner and task after the
    first step.
    """
    seen = candidates.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    by_owner = seen.groupBy("hash", "owner").agg(F.count("one").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_repos"), F.count("owner").alias("n_owners")).withColumn(
        "ownership", F.when(F.col("n_owners") >= example_owners, "example").otherwise("specific"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str | None = "source",
         repo_col: str | None = None, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """All kept spans per row of ``docs``.

    Columns: doc_id, text_hash, n_example, n_live (long), spans: array of (start,
    rank, kind, end, ownership, live), ordered.
    """
    found = staged(find(docs, id_col, text_col, owner_col, repo_col), "secrets")
    flat = found.filter(F.size("spans") > 0).select("doc_id", "text_hash", "owner", "repo", F.explode("spans").alias("s"))
    flat = flat.select("doc_id", "text_hash", "owner", "repo", "s.*")
    classes = ownership(flat, example_owners).select("hash", "ownership")
    kept = (
        flat.drop("owner", "repo").join(classes, "hash")
        .withColumn("live", F.col("random") & (F.col("ownership") == "specific"))
        .filter(F.col("kind").isin(*BASE) | F.col("live"))
    )
    per_doc = kept.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(
        F.struct("start", "rank", "kind", "end", "ownership", "live"))).alias("kept"))
    out = _with_spans(found.select("doc_id", "text_hash"), per_doc)
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    return out.select("doc_id", "text_hash", count(lambda s: s["ownership"] == "example").alias("n_example"),
                      count(lambda s: s["live"]).alias("n_live"), "spans")


def _with_spans(docs: DataFrame, per_doc: DataFrame) -> DataFrame:
    """Left join by (doc_id, text_hash); rows without spans get an empty array."""
    right = per_doc.select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"), F.col(per_doc.columns[-1]).alias("spans"))
    empty = F.array().cast(right.schema["spans"].dataType)
    on = docs["doc_id"].eqNullSafe(right["k_id"]) & (docs["text_hash"] == right["k_hash"])
    return docs.join(right, on, "left").drop("k_id", "k_hash").withColumn("spans", F.coalesce("spans", empty))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str | None = "source",
           repo_col: str | None = None, only_live: bool = False, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``docs`` with the same columns, each kept span replaced by ``[kind]``.

    A scan finds the spans; only documents that have some are looked up, so the
    join is with a small side, which adaptive execution broadcasts where its
    measured size allows. Spans that overlap are cut as their union, named by the
    earliest one (then the first kind). Code points outside spans are unchanged.
    """
    spans = scan(docs, id_col, text_col, owner_col, repo_col, example_owners).filter(F.size("spans") > 0)
    if only_live:
        spans = spans.withColumn("spans", F.filter("spans", lambda s: s["live"]))
    # repeated rows have equal spans
    per_doc = spans.groupBy("doc_id", "text_hash").agg(F.first("spans").alias("spans"))
    keyed = docs.select(F.struct("*").alias("given"), F.col(id_col).cast("long").alias("doc_id"),
                        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_hash"))
    joined = _with_spans(keyed, per_doc)
    text = F.col(f"given.`{text_col}`").cast("string")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cut = F.aggregate("spans", start, lambda a, s: F.when(s["start"] < a["at"], F.struct(
        F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(F.struct(
        s["end"].alias("at"),
        F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"))),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    new_text = F.when(F.size("spans") > 0, cut).otherwise(text)
    return joined.select(*[new_text.alias(c) if c == text_col else F.col(f"given.`{c}`").alias(c) for c in docs.columns])
