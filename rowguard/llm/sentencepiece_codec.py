"""Operator 1: SentencePiece encoding and decoding by streaming Viterbi.

A text is a lattice: positions are nodes, vocabulary pieces are edges. The
decoder walks it left to right and keeps, for every position, one surviving
backpointer (the best last piece). Only positions within the longest piece's
reach can still be extended, so as soon as the paths of all positions in that
window run through one common boundary, everything before the boundary is
final: its ids are committed and its backpointers are dropped.

Two models share that walk:

* unigram: the survivor is the piece with the best score sum;
* bpe: the survivor is the one piece that merge order allows after the piece
  before it. A sequence of pieces is what merging by rank produces exactly if
  every two neighbours are (they come out again when their joined text is
  merged), so the check is local, one position has one valid last piece, and
  the walk gives the ids of the merge procedure without merging whole texts.

Where no piece holds a space mark, sign or line end after another character
(which is read from the model), every word start, sign after a letter and line
begin is a boundary on which all paths agree, see ``spans.py``. A batch walks each
distinct span between two such boundaries once; spans of earlier batches are
remembered, bounded by bytes and forgotten with the task. Ids and surface bytes of
the batch are then gathered. A model without this property walks whole texts.

Defined results: null or empty text gives no ids and decodes to "" ; characters
without a piece become byte pieces, or the unknown id where the model has none
(then ``round_trip`` may be false; it also is for texts that hold U+2581, the
space mark itself). Repeated rows give repeated results; columns other than id
and text are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
import string
from array import array
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb

from rowguard.llm.common import documents, release, steps
from rowguard.llm.spans import gather, split, sums

#: public tokenizer file; a parameter of encode(), never copied
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: bytes of remembered spans in a task, and what an entry takes besides its characters and ids
MEMO_BYTES = 64 << 20
ENTRY_BYTES = 200
#: remembered neighbour checks
MEMO_PAIRS = 200_000
#: a span longer than this is never remembered
MEMO_CHARS = 48

SCHEMA = "doc_id long, n_ids long, n_byte_ids long, ids array<int>, decoded_sha256 string, round_trip boolean"


class Model:
    """Pieces, scores and settings of one SentencePiece model file."""

    def __init__(self, data: bytes):
        proto = model_pb.ModelProto()
        proto.ParseFromString(data)
        kinds = model_pb.ModelProto.SentencePiece
        self.bpe = proto.trainer_spec.model_type == model_pb.TrainerSpec.BPE
        if not self.bpe and proto.trainer_spec.model_type != model_pb.TrainerSpec.UNIGRAM:
            raise ValueError("only unigram and BPE models have a segmentation lattice")
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("only models with identity normalisation are supported")
        self.prefix = spec.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.vocab = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
        self.score = [p.score for p in proto.pieces]
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == kinds.UNKNOWN), 0)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.control = {i for i, k in enumerate(self.kinds) if k == kinds.CONTROL}
        self.longest = max(map(len, self.vocab), default=1)
        self.unknown_score = min((self.score[i] for i in self.vocab.values()), default=0.0) - 10.0
        self.neighbours: dict[int, bool] = {}
        normal = [p.piece for p in proto.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
        self.by_span = not any(map(ACROSS.search, normal))
        self.surface = [
            bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.control
            else " ⁇ ".encode() if i == self.unknown else p.replace(SPACE, " ").encode()
            for i, p in enumerate(self.pieces)]
        self.automaton = self.edges()

    # -- lattice -----------------------------------------------------------
    def merged(self, text: str) -> list[str]:
        """Merge neighbours by best score, leftmost first (short strings only)."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.vocab.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.score[k] > best):
                    best, at = self.score[k], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edges(self) -> ahocorasick.Automaton:
        """All pieces that segmentation can produce, found in one pass over a text."""
        found = ahocorasick.Automaton()
        for piece, k in self.vocab.items():
            if not self.bpe or len(piece) == 1 or len(self.merged(piece)) == 1:
                found.add_word(piece, (k, len(piece)))
        found.make_automaton()
        return found

    def follows(self, left: int, right: int, text: str) -> bool:
        """Whether merging the joined ``text`` of two pieces gives them back."""
        if left < 0 or right < 0:  # characters without a piece: not worth a memo
            return len(self.merged(text)) == 2
        key = left << 32 | right
        known = self.neighbours.get(key)
        if known is None:
            if len(self.neighbours) >= MEMO_PAIRS:
                self.neighbours.clear()
            known = self.neighbours[key] = self.merged(text) == [self.pieces[left], self.pieces[right]]
        return known

    def walk(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(piece id or -1, start, end) by streaming Viterbi, committed at common boundaries."""
        bpe, score, neighbours = self.bpe, self.score, self.neighbours
        base = 0                    # first position that is not committed
        back, last, best = [0], [-2], [0.0]     # by end - base; -2: nothing before, None: no path
        reach = ahead = self.longest
        matches = self.automaton.iter(text)
        match = next(matches, None)
        for end in range(1, len(text) + 1):
            choice, start_of, top, single = None, end - 1, -np.inf, False
            while match is not None and match[0] < end:  # longest first
                k, size = match[1]
                match = next(matches, None)
                single = single or size == 1
                start = end - size
                if start < base:
                    continue
                before = last[start - base]
                if before is None:
                    continue
                if bpe:
                    if choice is None and (before == -2 or neighbours.get(before << 32 | k) or self.follows(
                            before, k, text[back[start - base]:end])):
                        choice, start_of = k, start
                else:
                    s = best[start - base] + score[k]
                    if s > top:
                        choice, start_of, top = k, start, s
            if not single and last[end - 1 - base] is not None:  # a character that is no piece
                before = last[end - 1 - base]
                if not bpe:
                    s = best[end - 1 - base] + self.unknown_score
                    if s > top:
                        choice, start_of, top = -1, end - 1, s
                elif choice is None and (before == -2 or self.follows(before, -1, text[back[end - 1 - base]:end])):
                    choice, start_of = -1, end - 1
            back.append(start_of)
            last.append(choice)
            best.append(top)
            if end - base >= ahead and end < len(text):
                live = {e for e in range(max(base, end - reach + 1), end + 1) if last[e - base] is not None}
                while len(live) > 1:
                    e = max(live)
                    live.discard(e)
                    live.add(back[e - base])
                joint = live.pop()
                if joint > base:
                    yield from self.path(back, last, base, joint)
                    back, last, best = back[joint - base:], last[joint - base:], best[joint - base:]
                    base = joint
                ahead = end - base + (reach + 1) // 2
        yield from self.path(back, last, base, len(text))

    @staticmethod
    def path(back: list[int], last: list[int | None], base: int, end: int) -> list[tuple[int, int, int]]:
        out = []
        while end > base:
            out.append((last[end - base], back[end - base], end))
            end = back[end - base]
        return out[::-1]

    # -- text to ids and back ----------------------------------------------
    def ids_of(self, span: str) -> Iterator[int]:
        run = False                 # a run of characters without a piece is one unknown
        for k, start, end in self.walk(span):
            if k >= 0:
                run = False
                yield k
            elif self.bytes:
                yield from (self.bytes[b] for b in span[start:end].encode())
            elif not run:
                run = True
                yield self.unknown

    def marked(self, text: str) -> str:
        """The text as the lattice reads it."""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def encode(self, text: str) -> array:
        """Ids of one text by one walk over all of it."""
        return array("i", self.ids_of(self.marked(text)) if text else ())

    def decode(self, ids) -> str:
        """Text of ids; byte pieces join to UTF-8, broken sequences become U+FFFD."""
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


class Memo:
    """Ids by span, in two generations: the older half is forgotten when the newer one is full."""

    def __init__(self, model: Model, limit: int = MEMO_BYTES):
        self.model, self.limit = model, limit // 2
        self.newer, self.older, self.held = {}, {}, 0

    def __call__(self, span: str):
        ids = self.newer.get(span)
        if ids is not None:
            return ids
        ids = self.older.get(span)
        if ids is None:
            ids = tuple(self.model.ids_of(span))
        if len(span) <= MEMO_CHARS:
            self.held += ENTRY_BYTES + len(span) + 8 * len(ids)
            if self.held > self.limit:
                self.older, self.newer, self.held = self.newer, {}, 0
            self.newer[span] = ids
        return ids


class Codec:
    """Encodes and decodes batches of texts."""

    def __init__(self, model: Model):
        self.model, self.memo = model, Memo(model)
        self.surfaces = pa.array(model.surface, pa.large_binary())
        self.size = np.array([len(x) for x in model.surface], np.int64)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(where each text's ids end, ids of all texts)."""
        model = self.model
        offsets, codes, spans = split(texts, b" " if model.prefix else b"", whole=not model.by_span, fine=bool(model.bytes))
        found = [self.memo(s.decode().replace(" ", SPACE)) for s in spans.to_pylist()]
        ends = np.cumsum([len(f) for f in found], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(ends[-1]) if len(ends) else 0)
        size = np.diff(np.concatenate([[0], ends]))[codes] if len(codes) else np.zeros(0, np.int64)
        empty = pc.fill_null(pc.equal(pc.binary_length(texts), 0), True).to_numpy(zero_copy_only=False)
        # a null or empty text is its leading space alone, which is no id
        keep = np.repeat(~empty, np.diff(offsets))
        upto = np.cumsum(np.where(empty, 0, sums(size, offsets)))
        return upto, flat[gather(codes[keep], ends)]

    def surface(self, upto: np.ndarray, ids: np.ndarray) -> list[memoryview]:
        """The joined bytes of each text's ids."""
        joined = self.surfaces.take(pa.array(ids))
        at = np.concatenate([[0], np.cumsum(self.size[ids])])[np.concatenate([[0], upto])].tolist()
        data = memoryview(joined.buffers()[2] if len(ids) else b"")
        return [data[a:b] for a, b in zip(at, at[1:])]


#: a piece that would cross one of the boundaries at which texts are cut
ACROSS = re.compile("[A-Za-z][" + re.escape(string.punctuation.replace("'", "")) + "]|.\n|\n.|[^▁].*▁", re.S)


@functools.lru_cache(maxsize=1)
def _model(data: bytes) -> Model:
    """One model a worker: its size is that of its file and of its bounded neighbour checks."""
    return Model(data)


def _read(model_file: str) -> bytes:
    with open(model_file, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_file: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text, decoded again to prove the round trip.

    One narrow pass, no shuffle: a text stays in the task that read it. The
    model (about 0.5 MB, its size does not depend on the data) travels with the
    task as bytes, so executors need no local file.
    """
    data = _read(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(data)
        codec = Codec(model)
        is_byte = np.zeros(len(model.pieces), bool)
        is_byte[list(model.byte_of)] = True
        for batch in steps(batches):
            texts = batch.column("text")
            upto, ids = codec.ids(texts)
            sha, same = [], []
            for text, back in zip(texts.to_pylist(), codec.surface(upto, ids)):
                whole = (text or "").encode("utf-8", "surrogatepass")
                back = bytes(back[1:] if model.prefix and back[:1] == b" " else back)
                if back != whole:  # broken sequences become U+FFFD
                    back = back.decode("utf-8", "replace").encode()
                sha.append(hashlib.sha256(back).hexdigest())
                same.append(back == whole)
            n_bytes = sums(is_byte[ids].astype(np.int64), np.concatenate([[0], upto]))
            ends = np.concatenate([[0], upto])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(n_bytes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)), pa.array(sha, pa.string()), pa.array(same, pa.bool_())],
                ["doc_id", "n_ids", "n_byte_ids", "ids", "decoded_sha256", "round_trip"])
        del codec
        release()

    return documents(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, model_file: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts of id arrays (null ids: empty text). Columns: doc_id, text."""
    data = _read(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(data)
        for batch in batches:
            texts = [model.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")
                          ).mapInArrow(run, "doc_id long, text string")
