"""Operator 13: ranked lexical search by presence-mask grouping.

The index holds every term of every document: a row is a block of documents with
its terms, each with the documents that hold it and how often. Benchmark items
are a stated query set that visits every block. In a block, the documents of each
item's terms are bitmaps; read across the terms they give every document's mask
of matched terms, and documents with equal masks form a group. A mask has a
highest possible score, the sum over its terms of the block's best; masks are
evaluated in descending order of it, and as soon as the k-th score found is above
the next mask's highest, no document left can rank (equality goes on, since a
smaller id wins a tie). The k best of a task's earlier blocks count as found.

Scores are integers, exact in 64 bits: with N documents that hold a term, L terms
in all, df documents with the term, n terms in the document, tf of them this one,

    w = floor(1000 ln((2N + 2) / (2 df + 1))),  m = 100 - 75 + (75 n N) div L
    score = sum over the item's terms, repeats included, of w ((10^9 tf) div (1000 tf + 8 m))

Texts are read once and not shuffled; terms are kept as they are, not as hashes.
A task hands on at most k rows an item. The query set is read in slices of
bounded size, so what a task carries does not grow with the benchmark.

Defined results: null or empty texts have no terms, match nothing and do not
count in N; an item without terms, or none of whose terms scores, has no rows;
repeated document rows rank one after the other; a null document id ranks after
all others of equal score; equal items count once, items that share an id but
not a text rank apart under it, a null item id stays null; other columns are
ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rowguard.llm.common import ALNUM, ceil_div, documents, pack, staged, steps, unpack, words
from rowguard.llm.spans import gather

TOP = 10
#: characters of item text in one slice of the query set
SLICE_CHARS = 4_000_000
#: documents and bytes of text in one block
BLOCK_DOCS = 4096
BLOCK_BYTES = 8 << 20
#: terms whose bitmaps are turned at a time (a multiple of 64)
TURN = 512

INDEX = "n_docs long, n_all long, doc_ids array<long>, n_terms binary, terms array<string>, ends binary, docs binary, tfs binary"
ARROW_INDEX = pa.schema([("n_docs", pa.int64()), ("n_all", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_terms", pa.binary()),
                         ("terms", pa.list_(pa.string())), ("ends", pa.binary()), ("docs", pa.binary()), ("tfs", pa.binary())])
FOUND = "item int, doc_id long, score long"


def build_index(docs: DataFrame, block_bytes: int = BLOCK_BYTES, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row a block: terms, their documents and frequencies, of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, step_bytes=block_bytes):
            for at in range(0, step.num_rows, block_docs):
                yield _block(step.slice(at, block_docs))

    return documents(docs).mapInArrow(run, INDEX)


def _block(batch: pa.RecordBatch) -> pa.RecordBatch:
    offsets, codes, known = words(batch.column("text"), ALNUM)
    n = np.diff(offsets)
    used, codes = np.unique(codes, return_inverse=True)
    posting, tf = np.unique(codes * len(n) + np.repeat(np.arange(len(n)), n), return_counts=True)
    ends = np.cumsum(np.bincount(posting // len(n), minlength=len(used)))
    row = {"n_docs": int((n > 0).sum()), "n_all": int(n.sum()), "doc_ids": batch.column("doc_id").to_pylist(),
           "n_terms": pack(n.astype(np.uint64)), "terms": [known[k] for k in used], "ends": pack(ends.astype(np.uint32)),
           "docs": pack((posting % len(n)).astype(np.uint32)), "tfs": pack(tf.astype(np.uint32))}
    return pa.RecordBatch.from_pylist([row], schema=ARROW_INDEX)


class QuerySet:
    """Distinct terms of a slice of the items, and each item's terms with their number of repeats."""

    def __init__(self, texts: list[str]):
        offsets, codes, known = words(pa.array(texts, pa.large_string()), ALNUM)
        self.terms = pa.array(known, pa.string())
        self.items = [np.unique(codes[a:b], return_counts=True) for a, b in zip(offsets, offsets[1:])]


class Postings:
    """A block's postings of the terms that a query set asks for: ``begin`` and ``size`` by query term."""

    def __init__(self, batch: pa.RecordBatch, i: int, query: QuerySet):
        terms = batch.column("terms")[i].values
        asked = pc.index_in(terms, value_set=query.terms)
        there = np.flatnonzero(asked.is_valid().to_numpy(zero_copy_only=False))
        ends = unpack(batch.column("ends")[i].as_py(), np.uint32).astype(np.int64)
        slot = asked.take(pa.array(there)).to_numpy()
        self.begin, self.size = np.zeros(len(query.terms), np.int64), np.zeros(len(query.terms), np.int64)
        begins = np.concatenate([[0], ends])[:-1]
        self.begin[slot], self.size[slot] = begins[there], (ends - begins)[there]


def statistics(index: DataFrame, query: QuerySet) -> np.ndarray:
    """Each query term's df, over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(query.terms), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                df += Postings(batch, i, query).size
        there = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(df[there])], ["term", "df"])

    counts = np.zeros(len(query.terms), np.int64)
    for r in index.select("terms", "ends").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        counts[r.term] = r.df  # at most one row a term of the slice
    return counts


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def masks_of(local: np.ndarray, doc: np.ndarray, terms: int, docs: int) -> np.ndarray:
    """Masks of matched terms as bits of 64-bit words, one row a document, from the terms' bitmaps.

    ``local``, ``doc``: term (ascending) and document of each posting.
    """
    masks = np.zeros((docs, -(-terms // 64) * 8), np.uint8)
    for lo in range(0, terms, TURN):
        a, b = np.searchsorted(local, [lo, lo + TURN])
        bitmaps = np.zeros((min(TURN, terms - lo), docs), bool)
        bitmaps[local[a:b] - lo, doc[a:b]] = True
        turned = np.packbits(bitmaps, axis=0)
        masks[:, lo // 8:lo // 8 + len(turned)] = turned.T
    return masks


def groups_of(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a document of each distinct mask, each document's group), word by word of the masks."""
    of = np.zeros(len(masks), np.int64)
    for word in masks.view(np.uint64).T:
        _, own = np.unique(word, return_inverse=True)
        _, of = np.unique(of * (1 + own.max(initial=0)) + own, return_inverse=True)
    _, first = np.unique(of, return_index=True)
    return first, of


def best_of_block(local: np.ndarray, doc: np.ndarray, value: np.ndarray, terms: int, docs: int, top: int,
                  floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block that can be among an item's ``top`` best, with exact scores.

    ``value``: what each posting adds to its document's score, postings ascending
    by term and document. ``floor``: a score below which no document matters.
    """
    masks = masks_of(local, doc, terms, docs)
    first, of = groups_of(masks)
    highest = np.zeros(terms, np.int64)
    np.maximum.at(highest, local, value)
    most = np.zeros(len(first), np.int64)
    for lo in range(0, terms, TURN):
        bits = np.unpackbits(masks[first, lo // 8:(lo + TURN) // 8], axis=1)[:, :min(TURN, terms - lo)]
        most += bits @ highest[lo:lo + TURN]
    order = np.argsort(-most, kind="stable")
    members, ends = np.argsort(of, kind="stable"), np.cumsum(np.bincount(of, minlength=len(first)))
    keys = local * docs + doc
    found, scores = [], []
    limit, size, k = max(floor, 1), top, 0
    while k < len(order) and most[order[k]] >= limit:
        some = order[k:k + size]
        some = some[most[some] >= limit]
        who = members[gather(some, ends)]
        # a mask names the terms of its documents: only these are looked up
        at, term = np.nonzero(np.unpackbits(masks[who], axis=1))
        score = np.bincount(at, value[np.searchsorted(keys, term * docs + who[at])], len(who)) if _small(highest) else _sums(
            at, value[np.searchsorted(keys, term * docs + who[at])], len(who))
        found.append(who)
        scores.append(score.astype(np.int64))
        k, size = k + size, 2 * size
        have = np.concatenate(scores)
        if len(have) >= top:
            limit = max(limit, int(np.partition(have, len(have) - top)[len(have) - top]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    who, score = np.concatenate(found), np.concatenate(scores)
    return who[score >= limit], score[score >= limit]


def _small(highest: np.ndarray) -> bool:
    """Whether sums of these are exact as doubles, as bincount adds them."""
    return int(highest.sum()) < 1 << 53


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, at, values)
    return out


def search(index: DataFrame, query: QuerySet, n: int, total: int, top: int = TOP) -> DataFrame:
    """item (number in the slice), doc_id, score: each task's best documents of every item."""
    weights = np.array([weight(n, d) for d in statistics(index, query).tolist()], np.int64)
    # a term that weighs nothing adds nothing
    items = [(t[weights[t] > 0], c[weights[t] > 0] * weights[t][weights[t] > 0]) for t, c in query.items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int, int]]] = [[] for _ in items]   # (-score, null id, id), ascending
        for batch in batches:
            for i in range(batch.num_rows):
                post = Postings(batch, i, query)
                doc_ids = batch.column("doc_ids")[i].as_py()
                m = np.array([25 + 75 * k * n // total for k in unpack(batch.column("n_terms")[i].as_py(), np.uint64).tolist()], np.int64)
                asked = np.flatnonzero(post.size)
                if not len(asked):
                    continue
                # the block's postings of all query terms, and what one of weight 1 adds
                which = gather(np.arange(len(asked)), np.cumsum(post.size[asked]))
                which = which + np.repeat(post.begin[asked] - (np.cumsum(post.size[asked]) - post.size[asked]), post.size[asked])
                doc = unpack(batch.column("docs")[i].as_py(), np.uint32)[which].astype(np.int64)
                tf = unpack(batch.column("tfs")[i].as_py(), np.uint32)[which].astype(np.int64)
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
                ends = np.zeros(len(query.terms), np.int64)
                ends[asked] = post.size[asked]
                ends = np.cumsum(ends)
                for k, (terms, w) in enumerate(items):
                    here = post.size[terms] > 0
                    if not here.any():
                        continue
                    own, per = terms[here], w[here]
                    at = gather(own, ends)
                    local = np.repeat(np.arange(len(own)), post.size[own])
                    floor = -best[k][-1][0] if len(best[k]) == top else 0
                    who, score = best_of_block(local, doc[at], impact[at] * per[local], len(own), len(doc_ids), top, floor)
                    if len(who):
                        new = [(-s, doc_ids[d] is None, doc_ids[d] or 0) for d, s in zip(who.tolist(), score.tolist())]
                        best[k] = sorted(best[k] + new)[:top]
        rows = [(k, None if none else d, -s) for k, found in enumerate(best) for s, none, d in found]
        if rows:
            k, d, s = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(d, pa.int64()), pa.array(s, pa.int64())], ["item", "doc_id", "score"])

    return index.mapInArrow(run, FOUND)


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, slice_chars: int = SLICE_CHARS, id_col: str = "item_id",
         text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item with a score above 0."""
    spark = docs.sparkSession
    index = staged(build_index(docs, block_bytes), "ranked")
    n, total = (x or 0 for x in index.agg(F.sum("n_docs"), F.sum("n_all")).first())
    asked = items.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    slices = max(1, ceil_div(asked.agg(F.sum(F.length("text"))).first()[0] or 0, slice_chars))
    dealt = F.pmod(F.xxhash64("text"), F.lit(slices))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = None
    for k in range(slices):  # one slice at a time on the driver and in the tasks
        rows = asked.filter(dealt == k).collect()
        best = search(index, QuerySet([r.text for r in rows]), n, total, top)
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], StructType([
            StructField("item", IntegerType()), asked.schema["item_id"]]))
        part = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # a slice's items
        part = part if slices == 1 else staged(part, "ranked-part")
        found = part if found is None else found.unionByName(part)
    return found
