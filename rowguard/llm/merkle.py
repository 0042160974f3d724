"""Operator 4: document fingerprints as Merkle trees over sections and paragraphs.

Sections are parted by blank lines, paragraphs are lines, leaves are runs of up
to four words that end with their sentence; a long run without white space
(Chinese, base64, minified code) is cut at places that its own characters decide.
The leaves of a paragraph are its exact text, so hashes go up the tree: a
paragraph's is that of its leaves' hashes, a section's of its paragraphs', the
root's of the sections' hashes and the separators between them. Equal texts have
equal roots, and equal roots mean equal texts (128-bit hashes).

Comparing two trees goes down only where hashes differ: children that are equal
and in the same order are matched, the others between two matches are compared in
turn. That locates edits and gives the likeness, the share of leaves that match.

A fingerprint is one string: root ``:`` sections joined by ``;``, a section its
hash, then ``/`` and a paragraph each; a paragraph is its hash and its leaves'
hashes, eight hex digits each below the root (they locate, the root decides).

Neighbours by id: rows are dealt to id ranges (borders are estimated quantiles, at
most ``MAX_RANGES`` numbers, beyond which ranges grow), each range gets the first
document of the following one as a guard row, and one sorted pass per range sees
every document next to its follower. A range is a partition; the texts are
shuffled once.

Defined results: a null text is empty, and empty texts have the root of nothing;
rows without an id come first; rows that repeat an id are ordered by their text's
hash (they share one range, whose sort spills); a single document is its own
follower; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import ceil_div, documents, steps

#: characters of text in one id range
RANGE_CHARS = 24_000_000
MAX_RANGES = 20_000
SECTION = re.compile(r"(\n[^\S\n]*\n\s*)")
#: every character of a paragraph is in one leaf
LEAF = re.compile(r"(?:\s*+[^\s.!?。！？]++){1,4}[.!?。！？]*+|\s*+[.!?。！？]++|\s++")
#: a longer leaf is cut by content into pieces of so many characters
LONG, PIECE = 64, (8, 32)
DIGITS = 8
FIRST_ID = -(1 << 63)

SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, edits string")
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string()]
digest = xxhash.xxh3_128_digest


def pieces(run: str) -> list[str]:
    """Content-defined cuts: whether a cut is after a character depends on it and its two
    neighbours before, so an edit moves only the cuts near it."""
    c = np.frombuffer(run.encode("utf-32-le", "surrogatepass"), np.uint32)
    two, one = np.concatenate([[0, 0], c[:-2]]).astype(np.uint32), np.concatenate([[0], c[:-1]]).astype(np.uint32)
    mixed = ((c * np.uint32(257) + one) * np.uint32(257) + two) * np.uint32(2654435761)
    marks = np.flatnonzero((mixed >> np.uint32(20)) % 12 == 0) + 1
    out, begin, k = [], 0, 0
    while begin < len(run):
        while k < len(marks) and marks[k] - begin < PIECE[0]:
            k += 1
        end = min(int(marks[k]) if k < len(marks) else len(run), begin + PIECE[1], len(run))
        out.append(run[begin:end])
        begin = end
    return out


class Node:
    """A hash, the number of leaves below it, and the nodes below it."""

    __slots__ = ("hash", "n", "below")

    def __init__(self, hash_: bytes | str, n: int, below: list[Node]):
        self.hash, self.n, self.below = hash_, n, below


def _paragraph(text: str) -> Node:
    found = LEAF.findall(text)
    if any(len(leaf) > LONG for leaf in found):
        found = [p for leaf in found for p in (pieces(leaf) if len(leaf) > LONG else (leaf,))]
    hashes = [digest(leaf.encode("utf-8", "surrogatepass")) for leaf in found]
    return Node(digest(b"p" + b"".join(hashes)), len(hashes), [Node(h, 1, []) for h in hashes])


def tree(text: str | None) -> Node:
    """The document's root; below it sections, paragraphs and leaves."""
    parts = SECTION.split(text) if text else []
    sections, cover = [], []
    for k, part in enumerate(parts):
        if k % 2:
            cover.append(b"|" + part.encode())  # a separator
            continue
        paragraphs = [_paragraph(p) for p in part.split("\n")]
        section = Node(digest(b"s" + b"".join(p.hash for p in paragraphs)), sum(p.n for p in paragraphs), paragraphs)
        sections.append(section)
        cover.append(section.hash)
    return Node(digest(b"r" + b"".join(cover)), sum(x.n for x in sections), sections)


def printed(root: Node) -> str:
    short = lambda node: node.hash.hex()[:DIGITS]
    sections = ("/".join([short(s), *(short(p) + "".join(map(short, p.below)) for p in s.below)]) for s in root.below)
    return f"{root.hash.hex()}:{';'.join(sections)}"


def fingerprint(text: str | None) -> str:
    return printed(tree(text))


def parsed(print_: str) -> Node:
    """The tree of a fingerprint."""
    root, _, body = print_.partition(":")
    sections = []
    for section in body.split(";") if body else ():
        own, *paragraphs = section.split("/")
        below = []
        for p in paragraphs:
            found = [Node(p[i:i + DIGITS], 1, []) for i in range(DIGITS, len(p), DIGITS)]
            below.append(Node(p[:DIGITS], len(found), found))
        sections.append(Node(own, sum(p.n for p in below), below))
    return Node(root, sum(x.n for x in sections), sections)


def _matches(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Equal children in the same order: common ends first, between them the
    longest ascending run of the k-th occurrences of equal hashes."""
    lo, hi = 0, 0
    least = min(len(a), len(b))
    while lo < least and a[lo].hash == b[lo].hash:
        lo += 1
    while hi < least - lo and a[-1 - hi].hash == b[-1 - hi].hash:
        hi += 1
    at: dict = {}
    for j in range(len(b) - hi - 1, lo - 1, -1):
        at.setdefault(b[j].hash, []).append(j)
    pairs = [(i, at[a[i].hash].pop()) for i in range(lo, len(a) - hi) if at.get(a[i].hash)]
    ends, chain, before = [], [], []    # smallest last j of a run of each length, its pair, the pair before
    for k, (_, j) in enumerate(pairs):
        size = bisect_left(ends, j)
        before.append(chain[size - 1] if size else -1)
        ends[size:size + 1], chain[size:size + 1] = [j], [k]
    middle, k = [], chain[-1] if chain else -1
    while k >= 0:
        middle.append(pairs[k])
        k = before[k]
    return [(i, i) for i in range(lo)] + middle[::-1] + [(len(a) - i, len(b) - i) for i in range(hi, 0, -1)]


def compare(a: Node, b: Node, path: tuple = (), edits: list | None = None, depth: int = 2) -> int:
    """Leaves that match, going down where hashes differ.

    ``edits`` gets the (section, paragraph) positions, by ``a``, that differ; -1 for
    a whole section that only one of them has.
    """
    if a.hash == b.hash:
        return a.n
    common, i, j = 0, 0, 0
    for x, y in [*_matches(a.below, b.below), (len(a.below), len(b.below))]:
        for k in range(max(x - i, y - j)):  # between two matches, in turn
            here = (*path, i + k)
            paired = i + k < x and j + k < y
            if edits is not None and len(here) == depth:
                edits.append(here)
            elif edits is not None and len(here) < depth and not paired:
                edits.append((*here, -1))
            if paired and a.below[i + k].below:
                common += compare(a.below[i + k], b.below[j + k], here, edits if len(here) < depth else None, depth)
        if x < len(a.below):
            common += a.below[x].n
        i, j = x + 1, y + 1
    return common


def _share(a: Node, b: Node, common: int) -> float:
    if a.hash == b.hash:
        return 1.0
    total = a.n + b.n
    # unequal texts are never quite alike, even if only a separator differs
    return min(2 * common / total, total / (total + 1)) if total else 0.0


def likeness(a: str, b: str) -> float:
    """Of two fingerprints: 1 for equal roots, else twice the matching leaves over all leaves."""
    x, y = parsed(a), parsed(b)
    return _share(x, y, compare(x, y))


def differences(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) positions, by ``a``, where two fingerprints differ; -1: a whole section."""
    edits: list = []
    compare(parsed(a), parsed(b), edits=edits)
    return edits


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the beginning of ``following``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def with_followers(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """Rows (doc_id, text, guard) in id order within partitions; a guard row, if
    any, follows the last row of each range and is that row's follower only."""
    docs = documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                                  F.coalesce("doc_id", F.lit(FIRST_ID)).alias("key"))
    docs = docs.withColumn("tie", F.xxhash64("text"))
    ranges = min(MAX_RANGES, max(1, ceil_div(docs.agg(F.sum(F.length("text"))).first()[0] or 0, range_chars)))
    wanted = [i / ranges for i in range(1, ranges)]
    inner = sorted(set(docs.approxQuantile("key", wanted, 0.1 / ranges))) if wanted else []
    if inner:
        splits = [-float("inf"), *inner, float("inf")]
        docs = docs.withColumn("_key", F.col("key").cast("double"))
        docs = Bucketizer(splits=splits, inputCol="_key", outputCol="_range").transform(docs).drop("_key")
        docs = docs.withColumn("range", F.col("_range").cast("int")).drop("_range")
    else:
        docs = docs.withColumn("range", F.lit(0))
    # one row per range: the first (key, tie)
    firsts = sorted((r["range"], r["key"]) for r in docs.groupBy("range").agg(F.min("key").alias("key")).collect())
    guards = [(firsts[i - 1][0] if i else firsts[-1][0], k) for i, (_, k) in enumerate(firsts)]
    goes = docs.sparkSession.createDataFrame(guards, "to int, key long")
    heads = docs.join(F.broadcast(goes), "key").groupBy("to").agg(F.min(F.struct("tie", "key", "text")).alias("h"))
    rows = docs.select("range", F.lit(0).alias("guard"), "key", "tie", "doc_id", "text").union(
        heads.select("to", F.lit(1), "h.key", "h.tie", F.lit(None).cast("long"), "h.text"))
    # a range is a partition of its own, not one of several that a hash puts together
    return rows.repartitionById(len(inner) + 1, "range").sortWithinPartitions("range", "guard", "key", "tie").select(
        "doc_id", "text", "guard")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_chars: int = RANGE_CHARS) -> DataFrame:
    """Fingerprints of every text, of its edited text, and likeness to that and to the follower.

    ``edits``: the section and paragraph numbers ("0.2,0.3") that the edit changed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose follower has not been seen
        for batch in steps(batches):
            out = []
            for row in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("guard").to_pylist()):
                doc_id, text, guard = row
                own = tree(text)
                if held is not None:
                    before, before_text, before_own = held
                    new = edited(before_text, text)
                    new_own, edits = tree(new), []
                    near = _share(before_own, new_own, compare(before_own, new_own, edits=edits))
                    out.append((before, len(before_text), hashlib.sha256(new.encode()).hexdigest(), printed(before_own), printed(new_own),
                                near, _share(before_own, own, compare(before_own, own)), ",".join(f"{s}.{p}" for s, p in edits)))
                held = None if guard else (doc_id, text, own)
            columns = list(zip(*out)) if out else [[] for _ in NAMES]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS)], NAMES)

    return with_followers(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), range_chars).mapInArrow(run, SCHEMA)
