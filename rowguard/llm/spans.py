"""Spans: the parts of texts at which subword tokenizers can be cut.

A text is cut before every space that follows a character which is not white
space, between an ASCII letter and a sign (but not an apostrophe), and between a
line end that follows such a character and an ASCII letter. No token of a
byte-level tokenizer with the common word pattern crosses such a cut, and none of
a piece model whose pieces hold a space mark at their start only, no sign after a
letter and no line end, so the ids of a text are the ids of its spans in order. A
batch of texts therefore encodes each of its distinct spans once and gathers the
rest. Which tokenizer allows it is read from its file; others encode whole texts.

White space is judged with care: where a character might be Unicode white space,
or the space mark itself, there is no cut, and a longer span gives the same ids.
"""

from __future__ import annotations

import functools
import json
import os
import re
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_pb
from tokenizers import Tokenizer

#: bytes of spans that are joined for one call of a tokenizer
JOIN_BYTES = 2048

#: letters and signs among bytes
LETTER, SIGN = (np.isin(np.arange(256), np.frombuffer(x.encode(), np.uint8)) for x in (string.ascii_letters, string.punctuation.replace("'", "")))


def split(texts: pa.Array, lead: bytes = b"", whole: bool = False, fine: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Spans of texts, each text after ``lead`` (null: empty).

    ``whole``: a text is one span. ``fine``: cut at signs and line ends as well.

    Returns offsets (n + 1) into the codes, the codes of all spans in order, and
    the distinct spans (large_binary) that codes stand for.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    if lead:
        data = np.insert(data, np.repeat(at[:-1], len(lead)), np.tile(np.frombuffer(lead, np.uint8), n))
        at = at + len(lead) * np.arange(n + 1)
    cuts = np.zeros(len(data) + 1, bool)
    if not whole:
        solid = _solid(data)
        cuts[1:-1] = (data[1:] == 32) & solid[:-1]
        if fine:
            cuts[1:-1] |= LETTER[data[:-1]] & SIGN[data[1:]]
            cuts[2:-1] |= solid[:-2] & (data[1:-1] == 10) & LETTER[data[2:]]
    cuts[at] = True
    ends = np.flatnonzero(cuts)
    if not len(data):
        return np.zeros(n + 1, np.int64), np.zeros(0, np.int64), pa.array([], pa.large_binary())
    spans = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
    coded = spans.dictionary_encode()
    return np.searchsorted(ends, at), coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _solid(data: np.ndarray) -> np.ndarray:
    """Which bytes end a character that is surely no white space."""
    one, two = np.zeros_like(data), np.zeros_like(data)
    one[1:], two[2:] = data[:-1], data[:-2]
    spaced = ((one == 0xC2) & (data <= 0xA0)) | ((two == 0xE1) & (one == 0x9A)) | ((two == 0xE2) & ((one == 0x80) | (one == 0x81) | (one == 0x96)))
    spaced |= (two == 0xE3) & (one == 0x80)
    return (data > 32) & (data != 127) & ~((data > 127) & spaced)


def gather(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Index into a flat array of the items of each span in ``codes``, span k ending at ``ends[k]``."""
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    size = (ends - begins)[codes]
    upto = np.cumsum(size)
    total = int(upto[-1]) if len(upto) else 0
    return np.arange(total) + np.repeat(begins[codes] - (upto - size), size)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring offsets."""
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others, in order, for U+0100 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class SpanTokenizer:
    """Ids of distinct spans. Subclasses say how texts are encoded.

    ``surface``: the bytes of each id. Spans are joined to longer texts for the
    tokenizer's sake: those that begin with a space as they are, others with line
    ends between them. Where a span's ids end is found by their bytes; if these do
    not fit, spans are encoded one by one.
    """

    surface: list[bytes]
    #: whether the ids of a text are those of its spans
    by_span: bool

    def texts(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def alone(self, spans: list[str]) -> list[list[int]]:
        """Ids of each span, without a neighbour."""
        raise NotImplementedError

    def prepare(self) -> None:
        self.size = np.array([len(s) for s in self.surface], np.int64)

    def classes(self, spans: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Spans that can be joined as they are, and those that can with line ends between."""
        at = np.frombuffer(spans.buffers()[1], np.int64)[spans.offset:spans.offset + len(spans) + 1]
        data = np.frombuffer(spans.buffers()[2], np.uint8)
        solid, first, last = _solid(data), data[at[:-1]], at[1:] - 1
        ends = solid[last]
        line = (data[last] == 10) & (last > at[:-1]) & solid[np.maximum(last - 1, 0)]
        return (first == 32) & ends, (LETTER[first] | SIGN[first]) & (ends | line)

    def encode(self, spans: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(where each span's ids end, ids of all spans)."""
        n = len(spans)
        counts, parts, left = np.zeros(n, np.int64), [], np.ones(n, bool)
        if n and self.by_span:
            for of, between in zip(self.classes(spans), (b"", b"\n")):
                found = self.joined(spans.filter(pa.array(of)), between) if of.any() else None
                if found is not None:
                    counts[of] = found[0]
                    parts.append((np.flatnonzero(of), found[1]))
                    left &= ~of
        if left.any():
            single = self.alone([s.decode() for s in spans.filter(pa.array(left)).to_pylist()])
            counts[left] = [len(x) for x in single]
            parts.append((np.flatnonzero(left), _flat(single)))
        ends = np.cumsum(counts)
        out = np.empty(int(counts.sum()), np.int64)
        for of, ids in parts:
            out[gather(of, ends)] = ids
        return ends, out

    def joined(self, spans: pa.Array, between: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """(number of ids of each span, ids), or None if the bytes of ids do not fit the spans."""
        size = pc.binary_length(spans).to_numpy() + len(between)
        ends = np.cumsum(size)
        if between:
            data = b"".join(s + between for s in spans.to_pylist())
        else:
            first = np.frombuffer(spans.buffers()[1], np.int64)[spans.offset]
            data = spans.buffers()[2].slice(int(first), int(ends[-1])).to_pybytes()
        cuts = [0]
        while cuts[-1] < len(data):
            cuts.append(int(ends[min(np.searchsorted(ends, cuts[-1] + JOIN_BYTES), len(ends) - 1)]))
        lead = b" " + between if between else b""
        ids = _flat(self.texts([(lead + data[a:b]).decode() for a, b in zip(cuts, cuts[1:])]))
        upto = np.cumsum(self.size[ids])
        # the bytes of each text's lead stand before its first span
        ends = ends + len(lead) * np.searchsorted(cuts[1:], ends, "left") + len(lead)
        stop, start = ends - len(between), ends - size
        a, b = np.searchsorted(upto, start) + 1, np.searchsorted(upto, stop) + 1
        a[start == 0] = 0
        if not len(upto) or upto[-1] != ends[-1] or not np.array_equal(upto[b - 1], stop) or not np.array_equal(upto[a - 1][start > 0], start[start > 0]):
            return None
        own = np.zeros(len(ids) + 1, np.int64)
        np.add.at(own, a, 1)
        np.add.at(own, b, -1)
        return b - a, ids[np.cumsum(own)[:-1] > 0]


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.concatenate([np.array(x, np.int64) for x in lists]) if lists else np.empty(0, np.int64)


@functools.lru_cache(maxsize=2)
def byte_level_tokenizer(data: str, special_as_text: bool = False) -> ByteLevel:
    """One tokenizer a worker: its size is that of its file, whatever it has read."""
    return ByteLevel(data, special_as_text)


@functools.lru_cache(maxsize=2)
def piece_model(data: bytes) -> Pieces:
    return Pieces(data)


class ByteLevel(SpanTokenizer):
    """A tokenizer of the tokenizers library from its JSON text."""

    def __init__(self, data: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(data)
        self.tokenizer.encode_special_tokens = special_as_text
        spec, to_byte = json.loads(data), byte_level()
        added = spec.get("added_tokens") or []
        words = spec.get("pre_tokenizer") or {}
        self.by_span = (spec.get("normalizer") is None and words.get("type") == "ByteLevel" and words.get("use_regex", True)
                        and not words.get("add_prefix_space")
                        and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        special = {t["id"]: t["content"].encode() for t in added}
        self.surface = [b""] * (1 + max(vocabulary.values(), default=-1))
        for token, k in vocabulary.items():
            self.surface[k] = special[k] if k in special else bytes(to_byte.get(c, 63) for c in token)
        self.added = [] if special_as_text else [t["content"] for t in added]
        self.prepare()

    def texts(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    alone = texts

    def fine(self, texts: pa.Array) -> bool:
        """Whether no text holds an added token, which signs and letters may be part of."""
        return not any(pc.any(pc.match_substring(texts, t)).as_py() for t in self.added)


class Pieces(SpanTokenizer):
    """A model of the sentencepiece library; spans come with the space that the model itself puts first."""

    def __init__(self, data: bytes):
        proto = model_pb.ModelProto()
        proto.ParseFromString(data)
        spec = proto.normalizer_spec
        self.model = m = sentencepiece.SentencePieceProcessor(model_proto=data)
        pieces = [m.id_to_piece(k) for k in range(len(m))]
        across = re.compile("[A-Za-z][" + re.escape(string.punctuation.replace("'", "")) + "]|.\n|\n.|[^▁].*▁", re.S)
        whole = [p for k, p in enumerate(pieces) if not (m.is_byte(k) or m.is_control(k) or m.is_unknown(k))]
        self.by_span = (spec.add_dummy_prefix and not spec.precompiled_charsmap and not spec.remove_extra_whitespaces
                        and not any(map(across.search, whole)))
        self.surface = [bytes([int(p[3:5], 16)]) if m.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.prepare()

    def classes(self, spans: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        marked = pc.match_substring(spans, "▁").to_numpy(zero_copy_only=False)
        return tuple(of & ~marked for of in super().classes(spans))

    def texts(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)

    def alone(self, spans: list[str]) -> list[list[int]]:
        # after a letter and a line end, as the library takes a space alone for an empty text
        before = len(self.model.encode("a\n"))
        return [ids[before:] for ids in self.model.encode(["a\n" + s for s in spans], num_threads=1)] if self.by_span else self.texts(spans)
