"""Operator 10: benchmark decontamination over a distributed positional inverted index.

The corpus index is sharded by document: every row of the stored table is one
block of documents with its own inverted lists (term hash -> sorted positions;
positions of neighbouring documents never touch, so no phrase crosses texts).
Benchmark windows are a stated query set that visits every shard: a window is
dropped when one of its terms has no list there; otherwise the lists are
intersected, offset-adjusted, from the shard's rarest term on. Proximity matches
use the same lists: all terms of a window within ``SPREAD`` window lengths.

The query set is read in slices of bounded size, so that what a task carries
does not grow with the benchmark. The stored lists are those of all training
tokens, so one index serves any later benchmark; ``only`` restricts them to the
terms of one. Texts are read once and never shuffled.

Defined results: a null or empty text has no words and is clean; items without
words have no window; a null item id is listed as an empty string; items that
share an id count once; repeated document rows repeat their result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import ALNUM, ceil_div, documents, hashes, pack, staged, steps, unpack, words

WINDOW = 10
SPREAD = 2
#: characters of benchmark text in one slice of the query set
SLICE_CHARS = 4_000_000

INDEX = ("block long, doc_ids array<long>, text_hashes array<long>, starts binary, n_words array<long>, terms binary, ends binary, "
         "positions binary")
MATCH = ("block long, slot int, doc_id long, text_hash long, n_words long, hit_at array<int>, items array<string>, "
         "near_items array<string>")


def build_index(docs: DataFrame, terms: np.ndarray | None = None) -> DataFrame:
    """Positional inverted lists, one row per block of documents.

    ``terms``: sorted term hashes to keep lists of (all if None).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(steps(batches)):
            offsets, codes, known = words(batch.column("text"), ALNUM)
            h = hashes(known)
            starts = offsets + np.arange(len(offsets))  # one free position after each document
            at = np.arange(len(codes)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            if terms is not None and len(known):
                keep = np.isin(h, terms)[codes]
                codes, at = codes[keep], at[keep]
            rank = np.argsort(h, kind="stable")
            order_of = np.empty_like(rank)
            order_of[rank] = np.arange(len(rank))
            by = order_of[codes]
            order = np.argsort(by, kind="stable")
            counts = np.bincount(by, minlength=len(h))
            there = counts > 0
            row = {
                "block": [part << 32 | k], "doc_ids": [batch.column("doc_id").to_pylist()],
                "text_hashes": [batch.column("text_hash").to_pylist()], "starts": [pack(starts.astype(np.uint64), True)],
                "n_words": [np.diff(offsets).tolist()], "terms": [pack(h[rank][there], True)],
                "ends": [pack(np.cumsum(counts[there]).astype(np.uint64), True)],
                "positions": [pack(at[order].astype(np.uint32))],
            }
            yield pa.RecordBatch.from_pydict(row, schema=ARROW_INDEX)

    return documents(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, INDEX)


ARROW_INDEX = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("text_hashes", pa.list_(pa.int64())), ("starts", pa.binary()),
                         ("n_words", pa.list_(pa.int64())), ("terms", pa.binary()), ("ends", pa.binary()), ("positions", pa.binary())])
ARROW_MATCH = pa.schema([("block", pa.int64()), ("slot", pa.int32()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()),
                         ("hit_at", pa.list_(pa.int32())), ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])


class QuerySet:
    """Distinct windows of a slice of the benchmark, as rows of term hashes."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.ids = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.ids)}
        offsets, codes, known = words(pa.array([t for _, t in items], pa.large_string()), ALNUM)
        coded = hashes(known)[codes] if len(known) else np.zeros(0, np.uint64)
        self.terms, local = np.unique(coded, return_inverse=True)
        of: dict[tuple, set[int]] = {}
        for (item, _), a, b in zip(items, offsets, offsets[1:]):
            size = min(window, b - a)
            for k in range(a, b - size + 1) if size else ():
                of.setdefault(tuple(local[k:k + size].tolist()), set()).add(number[item])
        self.windows = [(np.array(w), sorted(i)) for w, i in of.items()]
        padded = np.full((len(self.windows), window), -1)
        for k, (w, _) in enumerate(self.windows):
            padded[k, :len(w)] = w
        self.padded = padded


def _within(values: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the sorted list."""
    i = np.searchsorted(lists, values)
    i[i == len(lists)] = 0
    return lists[i] == values


def _near(anchor: np.ndarray, lists: np.ndarray, reach: int) -> np.ndarray:
    """Which anchors have a list entry at most ``reach`` positions away."""
    i = np.searchsorted(lists, anchor)
    right = lists[np.minimum(i, len(lists) - 1)]
    left = lists[np.maximum(i - 1, 0)]
    return np.minimum(np.abs(right - anchor), np.abs(left - anchor)) <= reach


def search(index: DataFrame, query: QuerySet, window: int = WINDOW, spread: int = SPREAD) -> DataFrame:
    """One row per document of the index: word positions hit, items by phrase and by proximity."""
    def shard(row: dict) -> pa.RecordBatch:
        starts = unpack(row["starts"], np.uint64, True).astype(np.int64)
        terms, ends = unpack(row["terms"], np.uint64, True), unpack(row["ends"], np.uint64, True).astype(np.int64)
        positions = unpack(row["positions"], np.uint32).astype(np.int64)
        n = len(row["doc_ids"])
        items, near = [set() for _ in range(n)], [set() for _ in range(n)]
        hit = np.zeros(starts[-1] + 1, bool)
        if len(terms) and len(query.windows):
            slot = np.searchsorted(terms, query.terms)
            slot[slot == len(terms)] = 0
            found = terms[slot] == query.terms
            slot = np.where(found, slot, -1)
            begins = np.concatenate([[0], ends[:-1]])
            # -1 in a padded window is no term; index len(slot) stands for it
            alive = np.append(found, True)[query.padded].all(axis=1)
            size = np.append(ends - begins, 0)[slot]
            lists = lambda t: positions[begins[slot[t]]:ends[slot[t]]]
            for k in np.flatnonzero(alive):
                w, of = query.windows[k]
                order = np.argsort(size[w], kind="stable")  # the rarest term first
                first = lists(w[order[0]])
                at = first - order[0]
                at = at[at >= 0]
                for o in order[1:]:
                    if not len(at):
                        break
                    at = at[_within(at + o, lists(w[o]))]
                for d in np.unique(np.searchsorted(starts, at, "right") - 1) if len(at) else ():
                    items[d].update(of)
                for o in range(len(w)) if len(at) else ():
                    hit[at + o] = True
                close, reach = first, spread * len(w)
                for o in order[1:]:
                    if not len(close):
                        break
                    close = close[_near(close, lists(w[o]), reach)]
                # the whole reach must lie in the anchor's own document
                for d in np.unique(np.searchsorted(starts, close, "right") - 1) if len(close) else ():
                    own = close[(close >= starts[d]) & (close < starts[d + 1])]
                    if any(all((_in(lists(t), max(p - reach, starts[d]), min(p + reach, starts[d + 1] - 1))) for t in w) for p in own):
                        near[d].update(of)
        at = np.flatnonzero(hit)
        doc = np.searchsorted(starts, at, "right") - 1
        own = (at - starts[doc]).astype(np.int32)
        cuts = np.searchsorted(doc, np.arange(n + 1))
        names = lambda sets: [[query.ids[i] for i in sorted(s)] for s in sets]
        return pa.RecordBatch.from_arrays(
            [pa.array([row["block"]] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["text_hashes"], pa.int64()),
             pa.array(row["n_words"], pa.int64()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(own, pa.int32())),
             pa.array(names(items), pa.list_(pa.string())), pa.array(names(near), pa.list_(pa.string()))], schema=ARROW_MATCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield shard(batch.slice(i, 1).to_pylist()[0])

    return index.mapInArrow(run, MATCH)


def _in(sorted_list: np.ndarray, lo: int, hi: int) -> bool:
    return np.searchsorted(sorted_list, lo) < np.searchsorted(sorted_list, hi, "right")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, spread: int = SPREAD,
                  slice_chars: int = SLICE_CHARS, only: bool = False) -> DataFrame:
    """doc_id, text_hash (xxhash64), n_words, n_hit, items, near_items for every row of ``docs``.

    ``only``: store lists of the benchmark's terms alone, where it is one slice.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    slices = max(1, ceil_div(items.agg(F.sum(F.length("text"))).first()[0] or 0, slice_chars))
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
    queries = (QuerySet([(r.item_id, r.text) for r in items.filter(dealt == k).collect()], window) for k in range(slices))
    if slices == 1:
        queries = list(queries)
    index = staged(build_index(docs, queries[0].terms if only and slices == 1 else None), "positions")
    found = None
    for query in queries:  # one slice at a time on the driver and in the tasks
        part = search(index, query, window, spread)
        found = part if found is None else found.unionByName(staged(part, "matches"))
    if slices > 1:
        flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        found = found.groupBy("block", "slot").agg(F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.first("n_words").alias("n_words"),
                                                   flat("hit_at"), flat("items"), flat("near_items"))
    near = F.array_except("near_items", "items")
    return found.select("doc_id", "text_hash", "n_words", F.size("hit_at").cast("long").alias("n_hit"), "items", near.alias("near_items"))
