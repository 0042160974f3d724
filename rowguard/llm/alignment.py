"""Operator 12: cross-tokenizer alignment by diagonal run skipping.

A byte-level tokenizer (A, on space and text) and a piece model (B, which adds
that space) cut the same bytes. Each token ends at a byte offset; where tokens of
both end, a group ends. Most groups are one to one, so the walk keeps a shift
(index in B less index in A) and probes blocks of the two end arrays at that
shift, of 1, 2, 4, ... tokens while they are equal; in the first unequal block
halving finds the place. The irregular group there is resolved by a merge of the
two arrays up to the next common end, which updates the shift.

``align`` reads texts once and shuffles none of them. Spans (``spans.py``) end at
an end of both tokenizers, so a batch encodes and walks each distinct span once
and writes these, with the spans of each document, to the shared folder as one
row. From those rows come the links of the corpus (one per group: the A and the B
token that end there) as counts by id pair, and then the documents' rows.

The table of pairs has a bound that does not depend on the data: of two tokens
with a common end one is a suffix of the other, so there are at most as many
pairs of surfaces as bytes in both vocabularies' surfaces, times the ids that
share a surface (``pair_bound``). Only under that bound, which is checked, does
it go to the driver and to every task.

Defined results: null and empty texts, and texts whose joined token bytes differ
from space and text (they hold the space mark U+2581), have no tokens: counts 0,
``groups`` ''. Repeated rows repeat their result and count in the corpus as often
as they occur; a very long text is one row of its own batch; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import documents, pack, release, staged, steps, unpack
from rowguard.llm.spans import SpanTokenizer, byte_level_tokenizer, gather, piece_model, split, sums

#: public tokenizer files; parameters, never copied
TOKENIZER_A = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER_B = public_tokenizers.path("piece_bpe_32k.model")
#: bytes of text whose distinct spans are encoded together
BATCH_BYTES = 4 << 20

#: bytes of group strings in one result batch
RESULT_BYTES = 8 << 20

ARRAYS = ("offsets", "codes", "a_ends", "a_ids", "b_ends", "b_ids", "g_ends", "g_a", "g_b")
#: arrays that ascend: their steps are stored
ASCENDING = ("offsets", "a_ends", "b_ends", "g_ends", "g_a", "g_b")
#: one row a batch; arrays of unsigned 32-bit integers as compressed byte planes
BATCH = "doc_ids array<long>, " + ", ".join(f"{n} binary" for n in ARRAYS)
COUNTED = ("codes", "a_ids", "b_ids", "g_ends", "g_a", "g_b")
PAIRS = "a int, b int, n long"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def walk(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Index in a and in b of the last token of each group.

    ``a``, ``b``: ascending byte ends with the same last one.
    """
    starts, shifts = [], []     # runs of one-to-one groups: first index in a, shift
    stops = []
    i = shift = 0
    n = len(a)
    begin = 0
    while i < n:
        size = 1
        while i < n:
            part = a[i:i + size]
            if part == b[i + shift:i + shift + size]:
                i += len(part)
                size *= 2
                continue
            while size > 1:     # the first unequal end lies in this block
                size //= 2
                part = a[i:i + size]
                if part == b[i + shift:i + shift + size]:
                    i += len(part)
            break
        if i > begin:
            starts.append(begin)
            stops.append(i)
            shifts.append(shift)
        if i >= n:
            break
        j = i + shift           # an irregular group: merge up to the next common end
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        begin, shift = i, j - i  # its last tokens begin the next run
        i += 1
        if i >= n:
            starts.append(begin)
            stops.append(i)
            shifts.append(shift)
    size = np.array(stops, np.int64) - np.array(starts, np.int64)
    if not len(size):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    in_a = gather(np.arange(len(size)), np.cumsum(size)) + np.repeat(np.array(starts) - (np.cumsum(size) - size), size)
    return in_a, in_a + np.repeat(np.array(shifts), size)


def pair_bound(a: SpanTokenizer, b: SpanTokenizer) -> int:
    """Most id pairs whose surfaces can end together: one is a suffix of the other."""
    in_a, in_b = Counter(a.surface), Counter(b.surface)
    longer = lambda own, other: sum(n * sum(other[s[k:]] for k in range(len(s))) for s, n in own.items())
    return longer(in_a, in_b) + longer(in_b, in_a)


def _read(tokenizer_a: str, tokenizer_b: str) -> tuple[str, bytes]:
    with open(tokenizer_a, encoding="utf-8") as f, open(tokenizer_b, "rb") as g:
        return f.read(), g.read()


def _fits(tokenizer: SpanTokenizer, ends: np.ndarray, ids: np.ndarray, spans: pa.Array) -> np.ndarray:
    """Spans whose joined token bytes are the span's."""
    surfaces = pa.array(tokenizer.surface, pa.large_binary())
    joined = surfaces.take(pa.array(ids))
    upto = np.concatenate([[0], np.cumsum(tokenizer.size[ids])])[np.concatenate([[0], ends])]
    data = pa.py_buffer(joined.buffers()[2]) if len(ids) else pa.py_buffer(b"")
    whole = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(upto.astype(np.int64)), data])
    return pc.equal(whole, spans).to_numpy(zero_copy_only=False)


def batches_of(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B,
               batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row a batch of documents: distinct spans with ids and groups, and each document's spans."""
    data_a, data_b = _read(tokenizer_a, tokenizer_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, stored = byte_level_tokenizer(data_a, True), piece_model(data_b), zstandard.ZstdCompressor(level=3)
        for batch in steps(batches, step_bytes=batch_bytes):
            texts = batch.column("text")
            offsets, codes, spans = split(texts, b" ", whole=not (a.by_span and b.by_span))
            a_ends, a_ids = a.encode(spans)
            b_ends, b_ids = b.encode(spans)
            valid = _fits(a, a_ends, a_ids, spans) & _fits(b, b_ends, b_ids, spans)
            # documents without text, or with a span that does not fit, have no tokens
            empty = pc.fill_null(pc.equal(pc.binary_length(texts), 0), True).to_numpy(zero_copy_only=False)
            size = np.where((sums(~valid[codes], offsets) > 0) | empty, 0, np.diff(offsets))
            codes = codes[np.repeat(size > 0, np.diff(offsets))]
            offsets = np.concatenate([[0], np.cumsum(size)])
            a_ends, a_ids = _only(valid, a_ends, a_ids)
            b_ends, b_ids = _only(valid, b_ends, b_ids)
            g_a, g_b = walk(np.cumsum(a.size[a_ids]).tolist(), np.cumsum(b.size[b_ids]).tolist())
            g_ends = np.searchsorted(g_a, a_ends)  # a span's last tokens end a group
            arrays = dict(zip(ARRAYS, (offsets, codes, a_ends, a_ids, b_ends, b_ids, g_ends, g_a, g_b)))
            yield pa.RecordBatch.from_pydict({"doc_ids": [batch.column("doc_id").to_pylist()]} | {
                n: [stored.compress(pack(x.astype(np.uint32), n in ASCENDING))] for n, x in arrays.items()}, schema=ARROW_BATCH)
            del arrays, codes, spans, a_ids, b_ids, g_a, g_b
            release()

    return documents(docs).mapInArrow(run, BATCH)


ARROW_BATCH = pa.schema([("doc_ids", pa.list_(pa.int64()))] + [(n, pa.binary()) for n in ARRAYS])


def _only(valid: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends and ids with no ids left in spans that are not valid."""
    size = np.diff(np.concatenate([[0], ends]))
    return np.cumsum(np.where(valid, size, 0)), ids[np.repeat(valid, size)]


class Batch:
    """A stored batch: its arrays by name, and the id pair of each group as one number."""

    def __init__(self, batch: pa.RecordBatch, i: int, names: tuple[str, ...] = ARRAYS):
        stored = zstandard.ZstdDecompressor()
        for name in names:
            raw = stored.decompress(batch.column(name)[i].as_buffer())
            setattr(self, name, unpack(raw, np.uint32, name in ASCENDING).astype(np.int64))
        self.pairs = self.a_ids[self.g_a] << 32 | self.b_ids[self.g_b]

    @staticmethod
    def of(batches: Iterator[pa.RecordBatch], names: tuple[str, ...] = ARRAYS) -> Iterator[Batch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out = Batch(batch, i, names)
                if "doc_ids" in batch.schema.names:
                    out.doc_ids = batch.column("doc_ids")[i].values
                yield out
                del out
                release()


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, place = np.unique(keys, return_inverse=True)
    out = np.zeros(len(known), np.int64)
    np.add.at(out, place, counts)
    return known, out


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n: links of the corpus by id pair. Tasks add their own batches up first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in Batch.of(batches, COUNTED):
            often = np.bincount(b.codes, minlength=len(b.g_ends))
            links = np.repeat(often, np.diff(np.concatenate([[0], b.g_ends])))
            keys, counts = _merged(np.concatenate([keys, b.pairs]), np.concatenate([counts, links]))
        there = counts > 0
        if there.any():
            yield pa.RecordBatch.from_arrays([pa.array((keys[there] >> 32).astype(np.int32)), pa.array((keys[there] & 0xFFFFFFFF).astype(np.int32)),
                                              pa.array(counts[there])], ["a", "b", "n"])

    return aligned.select(*COUNTED).mapInArrow(run, PAIRS).groupBy("a", "b").agg(F.sum("n").alias("n"))


def documents_of(aligned: DataFrame, pairs: list, n_ids: int, batch_bytes: int = RESULT_BYTES) -> DataFrame:
    """Every document's groups and what its links count in the corpus.

    ``pairs``: rows of ``pair_counts``. ``n_ids``: the larger vocabulary's size.
    """
    keys = np.array([p.a << 32 | p.b for p in pairs] or [-1], np.int64)
    counts = np.array([p.n for p in pairs] or [0], np.int64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    _, of_b = np.unique(keys & 0xFFFFFFFF, return_inverse=True)
    highest = np.zeros(len(keys), np.int64)
    np.maximum.at(highest, of_b, counts)
    best = counts == highest[of_b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        for b in Batch.of(batches):
            words = words if words is not None else _words(n_ids)
            of_span = lambda values, ends: sums(values, np.concatenate([[0], ends]))
            of_doc = lambda values: sums(values[b.codes], b.offsets)
            ones = lambda ends: np.diff(np.concatenate([[0], ends]))
            known = np.searchsorted(keys, b.pairs)
            known = np.minimum(known, len(keys) - 1)  # pairs of spans that no kept document has
            groups = of_doc(ones(b.g_ends))
            columns = [of_doc(ones(b.a_ends)), of_doc(ones(b.b_ends)), groups, groups,
                       of_doc(of_span(best[known].astype(np.int64), b.g_ends)), of_doc(of_span(counts[known], b.g_ends))]
            spans, chars = _listed(b, words, n_ids)
            size = of_doc(chars)
            part = np.cumsum(size) // batch_bytes
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                flat = spans.take(pa.array(b.codes[b.offsets[lo]:b.offsets[hi]]))
                ends = np.concatenate([[0], np.cumsum(size[lo:hi])]).astype(np.int32)
                data = flat.buffers()[2] or pa.py_buffer(b"")
                told = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends), data])
                told = pc.binary_slice(told, 0, -1).cast(pa.string())  # no mark after the last group
                yield pa.RecordBatch.from_arrays(
                    [b.doc_ids.slice(lo, hi - lo), *(pa.array(c[lo:hi], pa.int64()) for c in columns), told],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    return aligned.mapInArrow(run, ALIGNED)


def _words(n: int) -> pa.Array:
    """Ids below ``n`` in decimal, each before a comma, then before a bar, then before a semicolon."""
    return pa.array([f"{k}{mark}" for mark in ",|;" for k in range(n)], pa.large_binary())


def _listed(b: Batch, words: pa.Array, n: int) -> tuple[pa.Array, np.ndarray]:
    """Each span's groups as text, "a1,a2|b1;" a group, and their lengths."""
    g = len(b.g_a)
    a, c = np.arange(len(b.a_ids)), np.arange(len(b.b_ids))
    of_a, of_b = np.searchsorted(b.g_a, a), np.searchsorted(b.g_b, c)
    before_b = np.concatenate([[0], b.g_b + 1])[of_a]   # B tokens of earlier groups
    before_a = (b.g_a + 1)[of_b] if g else of_b         # A tokens up to this group
    out = np.empty(len(a) + len(c), np.int64)
    out[a + before_b] = b.a_ids + np.where(b.g_a[of_a] == a, n, 0) if g else 0
    out[c + before_a] = b.b_ids + np.where(b.g_b[of_b] == c, 2 * n, 0) if g else 0
    flat = words.take(pa.array(out))
    size = pc.binary_length(flat).to_numpy()
    upto = np.concatenate([[0], np.cumsum(size)])
    ends = upto[b.a_ends + b.b_ends]
    whole = np.concatenate([[0], ends]).astype(np.int64)
    data = flat.buffers()[2] if len(out) else pa.py_buffer(b"")
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(whole), data]), np.diff(whole)


def align(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B) -> DataFrame:
    """doc_id, token, group and link counts, n_best, count_sum and the groups of every document.

    ``groups``: "a1,a2|b1;a3|b2,b3", the A and B ids of each group.
    """
    aligned = staged(batches_of(docs, tokenizer_a, tokenizer_b), "aligned")
    data_a, data_b = _read(tokenizer_a, tokenizer_b)
    a, b = byte_level_tokenizer(data_a, True), piece_model(data_b)
    bound = pair_bound(a, b)
    pairs = pair_counts(aligned).limit(bound + 1).collect()
    if len(pairs) > bound:
        raise ValueError("more id pairs than the vocabularies' surfaces allow")
    return documents_of(aligned, pairs, max(len(a.surface), len(b.surface)))
