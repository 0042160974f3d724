"""Operator 3: language-model scores from a weighted backoff automaton.

The model is an interpolated word bigram. As an automaton: a state per history
word, an arc per seen word pair that carries log10 P(w|h), and a failure arc to
the unigram state with weight log10 L(h); the unigram state has an arc for every
word, unknown ones included, and reading a word leads to that word's state. The
end of a text is a token, and its state starts the next text.

    P(w|h) = (1 - L(h)) c(hw)/c(h) + L(h) P(w),  P(w) = (c(w)+a)/(N + a(V+1))

sums to one for every history; L falls with c(h), as frequent histories have
more evidence. A text is read once, left to right.

The tables of the automaton grow with the corpus, so no task and no driver ever
holds them whole. Texts become blocks of word codes (written once). Every block
asks for the counts of its distinct words and word pairs; requests are sorted
hash ranges, one row per block and range. A range is summed in one task (a word
is one request per block there, however often it occurs) and answered in the
order of the request, so answers carry no keys. Blocks meet their answers by
block number; texts are never shuffled. A task holds one block or one range, and
works through a block's tokens in chunks.

Defined results: a null or empty text is its end token only; a null id counts as
the empty text in crc32 and so is held out; without training rows every token is
unknown and P(w) is 1; repeated rows count, and are scored, once each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import ceil_div, crc_mod_py, documents, hashes, mix, pack, run_lengths, staged, steps, unpack, words

#: add-a smoothing of the unigram state
ADD = 0.1
#: backoff weight: floor, rise at rare histories
BACKOFF = (0.4, 0.3)
BLOCK_BYTES = 4 << 20
#: tokens of a block that are worked on at a time
CHUNK = 1 << 17
#: requests that one task sums
RANGE_REQUESTS = 1 << 19
#: hash that stands for the end of a text
END = np.uint64(0x5851F42D4C957F2D)

BLOCKS = ("block long, doc_ids array<long>, lengths binary, codes binary, vocabulary binary, "
          "train_docs long, train_tokens long, n_requests long")
REQUESTS = "part int, block long, kind int, keys binary, counts binary"
ANSWERS = "part int, block long, kind int, totals binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
WORD, PAIR, DISTINCT = 0, 1, 2


def _arrow(**fields) -> pa.Schema:
    return pa.schema(list(fields.items()))


def _held(doc_ids: list, mod: int) -> np.ndarray:
    return np.array([crc_mod_py(i, mod) == 0 for i in doc_ids], bool)


class Block:
    """The tokens of one block as word ranks in hash order; the end token is -1."""

    def __init__(self, lengths: np.ndarray, codes: np.ndarray, vocabulary: np.ndarray, doc_ids: list, mod: int):
        self.held = _held(doc_ids, mod)
        self.n = len(lengths)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)]).astype(np.int64)
        self.seq = np.full(self.starts[-1], -1, np.int32)
        if len(codes):
            self.seq[np.arange(len(codes)) + np.repeat(np.arange(self.n), lengths)] = codes
        self.train = ~np.repeat(self.held, lengths + 1)
        self.vocabulary = vocabulary
        self.history = np.roll(self.seq, 1)  # before the first token stands an end, as after the last

    def chunks(self) -> Iterator[slice]:
        return (slice(a, a + CHUNK) for a in range(0, len(self.seq), CHUNK))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct hashes of (history, word), and every token's place among them."""
        h = np.append(self.vocabulary, END)
        first, second = h * np.uint64(0x9E3779B97F4A7C15), mix(h)
        keys = np.empty(len(self.seq), np.uint64)
        for at in self.chunks():
            keys[at] = mix(first[self.history[at]] + second[self.seq[at]])
        order = np.argsort(keys)
        known, starts = run_lengths(keys[order])
        place = np.empty(len(keys), np.int32)
        place[order] = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, len(keys))))
        return known, place


def make_blocks(docs: DataFrame, mod: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(steps(batches, step_bytes=BLOCK_BYTES)):
            offsets, codes, known = words(batch.column("text"))
            h = hashes(known)
            rank = np.argsort(h, kind="stable")
            of = np.empty_like(rank)
            of[rank] = np.arange(len(rank))
            used = np.zeros(len(h), bool)
            used[codes] = True  # the dictionary may hold the empty word
            kept = np.cumsum(used[rank]) - 1
            codes = kept[of[codes]] if len(codes) else codes
            ids, lengths = batch.column("doc_id").to_pylist(), np.diff(offsets)
            train = ~_held(ids, mod)
            yield pa.RecordBatch.from_pydict({
                "block": [part << 32 | k], "doc_ids": [ids], "lengths": [pack(lengths.astype(np.uint64))],
                "codes": [pack(codes.astype(np.uint32))], "vocabulary": [pack(h[rank][used[rank]], True)],
                "train_docs": [int(train.sum())], "train_tokens": [int((lengths + 1)[train].sum())],
                "n_requests": [int(len(codes) + used.sum())]}, schema=_arrow(
                    block=pa.int64(), doc_ids=pa.list_(pa.int64()), lengths=pa.binary(), codes=pa.binary(), vocabulary=pa.binary(),
                    train_docs=pa.int64(), train_tokens=pa.int64(), n_requests=pa.int64()))

    return documents(docs).mapInArrow(run, BLOCKS)


def _read(row: dict, mod: int) -> Block:
    return Block(unpack(row["lengths"], np.uint64).astype(np.int64), unpack(row["codes"], np.uint32).astype(np.int64),
                 unpack(row["vocabulary"], np.uint64, True), row["doc_ids"], mod)


def _ranges(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, begin, end) of the equal hash ranges that sorted keys touch; the
    work is that of the keys, however many ranges there are."""
    of, begins = run_lengths(((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32))
    return list(zip(of.tolist(), begins.tolist(), [*begins[1:].tolist(), len(keys)]))


def requests(blocks: DataFrame, parts: int, mod: int) -> DataFrame:
    schema = _arrow(part=pa.int32(), block=pa.int64(), kind=pa.int32(), keys=pa.binary(), counts=pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                b = _read(row, mod)
                real = b.seq >= 0
                counts = np.bincount(b.seq[real & b.train], minlength=len(b.vocabulary))
                keys, place = b.pairs()
                for kind, k, c in ((WORD, b.vocabulary, counts), (PAIR, keys, np.bincount(place[b.train], minlength=len(keys)))):
                    cut = _ranges(k, parts)
                    yield pa.RecordBatch.from_pydict({
                        "part": [p for p, _, _ in cut], "block": [row["block"]] * len(cut), "kind": [kind] * len(cut),
                        "keys": [pack(k[i:j], True) for _, i, j in cut],
                        "counts": [pack(c[i:j].astype(np.uint32)) for _, i, j in cut]}, schema=schema)

    return blocks.mapInArrow(run, REQUESTS)


def answers(asked: DataFrame) -> DataFrame:
    """Totals per request, in its order, and the number of distinct training words per range."""
    def total(table: pa.Table) -> pa.Table:
        out = {"part": [], "block": [], "kind": [], "totals": []}
        part = table.column("part")[0].as_py()
        for kind in (WORD, PAIR):
            rows = table.filter(pc.equal(table.column("kind"), kind))
            if not rows.num_rows:
                continue
            keys = [unpack(k, np.uint64, True) for k in rows.column("keys").to_pylist()]
            counts = [unpack(c, np.uint32) for c in rows.column("counts").to_pylist()]
            sizes = [len(k) for k in keys]
            keys, counts = np.concatenate(keys), np.concatenate(counts).astype(np.uint64)
            order = np.argsort(keys, kind="stable")
            _, starts = run_lengths(keys[order])
            sums = np.add.reduceat(counts[order], starts)
            totals = np.empty(len(keys), np.uint64)
            totals[order] = np.repeat(sums, np.diff(np.append(starts, len(keys))))
            for block, blob in zip(rows.column("block").to_pylist(), np.split(totals, np.cumsum(sizes)[:-1])):
                for name, value in (("part", part), ("block", block), ("kind", kind), ("totals", pack(blob))):
                    out[name].append(value)
            if kind == WORD:
                distinct = np.array([np.count_nonzero(sums)], np.uint64)
                for name, value in (("part", part), ("block", -1), ("kind", DISTINCT), ("totals", pack(distinct))):
                    out[name].append(value)
        return pa.Table.from_pydict(out, schema=_arrow(part=pa.int32(), block=pa.int64(), kind=pa.int32(), totals=pa.binary()))

    return asked.groupBy("part").applyInArrow(total, ANSWERS)


def score(docs: DataFrame, mod: int = 10, id_col: str = "doc_id", text_col: str = "text",
          backoff: tuple[float, float] = BACKOFF) -> DataFrame:
    """Scores of every row; the model learns from rows whose crc32(id) mod ``mod`` is not 0."""
    blocks = staged(make_blocks(documents(docs, id_col, text_col), mod), "blocks")
    docs_n, tokens_n, asked_n = (x or 0 for x in blocks.agg(F.sum("train_docs"), F.sum("train_tokens"), F.sum("n_requests")).first())
    parts = max(1, ceil_div(asked_n, RANGE_REQUESTS))
    told = staged(answers(requests(blocks, parts, mod)), "answers")
    distinct = sum(int(unpack(r.totals, np.uint64)[0]) for r in told.filter(F.col("kind") == DISTINCT).select("totals").toLocalIterator())
    distinct += docs_n > 0  # the end token
    whole = tokens_n + ADD * (distinct + 1)

    def traverse(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        b = _read(row, mod)
        def counts(kind):
            rows = right.filter(pc.equal(right.column("kind"), kind)).sort_by("part")
            blobs = [unpack(t, np.uint64) for t in rows.column("totals").to_pylist()]
            return np.concatenate(blobs).astype(np.float64) if blobs else np.zeros(0)
        of_word, of_pair = np.append(counts(WORD), docs_n), counts(PAIR)  # the end token is rank -1
        place = b.pairs()[1]
        known, base, full = np.empty(len(place), np.int32), np.empty(len(place)), np.empty(len(place))
        for at in b.chunks():
            c, c_history = of_word[b.seq[at]], of_word[b.history[at]]
            unigram = (c + ADD) / whole
            fail = np.where(c_history > 0, backoff[0] + backoff[1] * (1 + c_history) ** -0.25, 1.0)
            p = (1 - fail) * of_pair[place[at]] / np.maximum(c_history, 1) + fail * unigram
            known[at], base[at], full[at] = c > 0, np.log10(unigram), np.log10(p)
        at = b.starts[:-1]
        return pa.Table.from_pydict({
            "doc_id": row["doc_ids"], "held_out": b.held, "n_tokens": np.diff(b.starts),
            "n_known": np.add.reduceat(known, at, dtype=np.int64), "train_tokens": np.full(b.n, tokens_n, np.int64),
            "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(full, at)},
            schema=_arrow(doc_id=pa.int64(), held_out=pa.bool_(), n_tokens=pa.int64(), n_known=pa.int64(), train_tokens=pa.int64(),
                          base_score=pa.float64(), score=pa.float64()))

    told = told.filter(F.col("kind") != DISTINCT)
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(traverse, SCORES)
