"""Operator 6: near-duplicate groups by b-bit MinHash.

1. One pass over the texts gives, per document, the number of distinct word
   shingles, a hash of the whole shingle set, band keys over full minima, and
   the low ``BITS`` bits of all minima packed into eight longs.
2. Documents with equal sets are one node (copies are never expanded).
3. Bands propose candidates. In each bucket every node is first paired with the
   bucket's smallest node only; candidates are kept by the size ratio (exact)
   and by the similarity that equal lanes of the packed signatures estimate,
   corrected for the chance collisions of b bits.
4. Surviving candidates are confirmed on full shingle sets and links merged into
   components. Nodes that a bucket still holds outside its smallest node's
   component are then paired with a few guides of the bucket, and the likeliest
   pair of each is confirmed: this connects nearly all of a large group at a cost
   linear in its size.
5. Every bucket that still holds more than one component compares the nodes of
   different components, so that no link is lost; nodes that are already
   connected are not compared again. Wider signatures keep pairs that are close
   to, but below, the threshold from being confirmed in numbers. Large buckets
   are dealt over tiles.

Recall: a pair at the threshold shares none of the ``BANDS`` bands with
probability (1 - 0.8^4)^32 = 5e-8, and the estimate lies ``MARGIN`` (over five
standard deviations) below the threshold with less than 1e-6. Node ids are
64-bit hashes of shingle sets.

Defined results: a text without words has 0 shingles, its own component and is
kept; a row without an id is never linked, has a null component and is kept;
rows that repeat an id with one text share its result, and an id with several
texts has a result for each (``text_hash`` tells them apart); other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import documents, release, hashes, mix, staged, steps, words

BANDS, ROWS, BITS = 32, 4, 4
PERMUTATIONS = BANDS * ROWS
LONGS = PERMUTATIONS * BITS // 64
#: the estimate may lie so far below the threshold
MARGIN = 0.2
#: a second, wider signature for nodes that still lie in buckets of several
#: components: permutations, bits, and its margin (over five standard deviations)
WIDE, WIDE_BITS, WIDE_MARGIN = 1024, 2, 0.08
#: nodes of one bucket that one task compares with others
TILE = 2000
#: about so many nodes of a bucket, chosen by hash, guide the others to a component
GUIDES = 8
SIG = [f"s{i}" for i in range(LONGS)]
SCHEMA = ("doc_id long, text_hash long, n_shingles long, node long, bands array<long>, "
          + ", ".join(f"{s} long" for s in SIG))


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:n] | np.uint64(1), seeds[n:]


def shingle_set(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size``-word shingles (fewer words: the whole sequence)."""
    if not len(word_hashes):
        return word_hashes
    n = max(len(word_hashes) - size + 1, 1)
    width = min(size, len(word_hashes))
    h = np.full(n, np.uint64(width))
    for i in range(width):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i:i + n])
    return np.unique(h)


def minima(shingles: np.ndarray, hashed: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    mul, add = hashed
    low = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    width = 2 ** 18 // len(mul)  # a very long text needs no more memory
    for i in range(0, len(shingles), width):
        np.minimum(low, (mul[:, None] * shingles[None, i:i + width] + add[:, None]).min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + column)
    return h.view(np.int64)


def packed(low: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` of all minima, 64 / bits lanes a long."""
    lanes = (low & np.uint64((1 << bits) - 1)).reshape(-1, 64 // bits)
    shifts = np.arange(lanes.shape[1], dtype=np.uint64) * np.uint64(bits)
    return np.bitwise_or.reduce(lanes << shifts, axis=1).view(np.int64)


def shingles_of(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    offsets, codes, known = words(texts)
    coded = hashes(known)[codes] if len(known) else np.zeros(0, np.uint64)
    for a, b in zip(offsets, offsets[1:]):
        yield shingle_set(coded[a:b], size)


def signatures(docs: DataFrame, size: int = 4) -> DataFrame:
    """One row per document row: set size, node, band keys and packed signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = permutations(PERMUTATIONS)
        for batch in steps(batches):
            n, node, bands, sigs = [], [], [], []
            for s in shingles_of(batch.column("text"), size):
                low = minima(s, hashed)
                n.append(len(s))
                node.append(xxhash.xxh3_64_intdigest(s.tobytes()))
                bands.append(band_keys(low))
                sigs.append(packed(low, BITS))
            sigs = np.array(sigs, np.int64)
            ends = pa.array(np.arange(len(n) + 1) * BANDS, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()),
                 pa.array(np.array(node, np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(bands))), *[pa.array(c) for c in sigs.T]],
                ["doc_id", "text_hash", "n_shingles", "node", "bands", *SIG])
        release()

    return documents(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, SCHEMA)


def _unequal(x: Column, bits: int) -> Column:
    """How many lanes of a long (two signatures' exclusive or) are not zero."""
    ones = sum(1 << (bits * i) for i in range(64 // bits))
    folded = x
    for i in range(1, bits):
        folded = folded.bitwiseOR(F.shiftrightunsigned(x, i))
    return F.bit_count(folded.bitwiseAND(F.lit(ones).cast("long")))


def _corrected(unequal: Column, permutations_n: int, bits: int) -> Column:
    chance = 2.0 ** -bits
    return ((1 - unequal / permutations_n) - chance) / (1 - chance)


def estimate(left: str, right: str) -> Column:
    """Collision-corrected similarity of two packed signatures by bit counts."""
    unequal = F.lit(0)
    for s in SIG:
        unequal = unequal + _unequal(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}")), BITS)
    return _corrected(unequal, PERMUTATIONS, BITS)


def wide_estimate(left: str, right: str) -> Column:
    lanes = F.zip_with(f"{left}.wide", f"{right}.wide", lambda a, b: _unequal(a.bitwiseXOR(b), WIDE_BITS))
    return _corrected(F.aggregate(lanes, F.lit(0), lambda a, x: a + x), WIDE, WIDE_BITS)


def _possible(left: str, right: str, percent: int) -> Column:
    a, b = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent) & (estimate(left, right) >= percent / 100 - MARGIN)


def _texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes: the text of each node's first document."""
    keyed = nodes.join(wanted, "node").select("node", F.col("first.doc_id").alias("k_id"), F.col("first.text_hash").alias("k_hash"))
    source = documents(docs).withColumn("text_hash", F.xxhash64("text"))
    return source.join(keyed, (source["doc_id"] == keyed["k_id"]) & (source["text_hash"] == keyed["k_hash"])).select(
        "node", "text").dropDuplicates(["node"])


def wide_signatures(texts: DataFrame, size: int) -> DataFrame:
    """(node, wide): longer signatures, which tell near the threshold apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = permutations(WIDE)
        for batch in steps(batches):
            wide = [packed(minima(s, hashed), WIDE_BITS) for s in shingles_of(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([w.tolist() for w in wide], pa.list_(pa.int64()))], ["node", "wide"])
        release()

    return texts.mapInArrow(run, "node long, wide array<long>")


def confirm(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold.

    Only texts of nodes that occur in a pair move; both texts of a pair meet in
    one row, so no group is gathered.
    """
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = _texts(wanted, nodes, docs)
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text_a", 1 << 20):
            keep = []
            for x, y in zip(shingles_of(batch.column("text_a"), size), shingles_of(batch.column("text_b"), size)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    return both.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the connected component of every node of ``links`` (a, b).

    Contraction: every node points to its smallest neighbour, pointers are
    followed, links are rewritten to what their ends point at and loops dropped,
    until no link is left. Each round is written out, so plans stay short and a
    lost executor re-reads one round.
    """
    links = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    mapping = None
    while not links.isEmpty():
        sides = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
        up = sides.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m"))
        up = staged(up.select("x", F.least("x", "m").alias("p")), "up")
        for _ in range(2):  # pointers are acyclic: they only go down
            above = up.select(F.col("x").alias("p"), F.col("p").alias("pp"))
            up = up.join(above, "p", "left").select("x", F.coalesce("pp", "p").alias("p"))
        up = staged(up, "up")
        a, b = up.select(F.col("x").alias("a"), F.col("p").alias("pa")), up.select(F.col("x").alias("b"), F.col("p").alias("pb"))
        links = staged(links.join(a, "a").join(b, "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                       .filter("a < b").distinct(), "links")
        if mapping is None:
            mapping = up.select(F.col("x").alias("node"), F.col("p").alias("comp"))
        else:
            mapping = staged(mapping.join(up.select(F.col("x").alias("comp"), "p"), "comp", "left")
                             .select("node", F.coalesce("p", "comp").alias("comp")), "comp")
    if mapping is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return mapping


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for every row of ``docs``."""
    docs = documents(docs, id_col, text_col)
    signed = staged(signatures(docs, size), "signatures")
    nodes = staged(
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("node").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"), *[F.first(s).alias(s) for s in SIG]), "nodes")
    lean = nodes.select("node", "n_shingles", "bands", *SIG)
    rows = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = rows.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = staged(rows.join(buckets, "key"), "buckets")  # only buckets that hold a pair

    # every node with the smallest node of its buckets
    stars = rows.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    stars = staged(
        stars.join(lean.alias("x"), F.col("a") == F.col("x.node")).join(lean.alias("y"), F.col("b") == F.col("y.node"))
        .filter(_possible("x", "y", percent)).select("a", "b", estimate("x", "y").alias("likeness")), "stars")
    best = stars.groupBy("a").agg(F.max(F.struct("likeness", "b")).alias("top")).select("a", F.col("top.b").alias("b"))
    links = staged(confirm(best, nodes, docs, size, percent), "confirmed")
    comps = components(links)

    # the other star pairs, where they would still connect something
    apart = _apart(stars.join(best, ["a", "b"], "left_anti"), comps).select("a", "b")
    links = _and(links, confirm(staged(apart, "apart"), nodes, docs, size, percent))
    comps = components(links)

    # buckets that hold several components: first a few guides of each bucket
    side = staged(_mixed(rows, comps, lean), "mixed")
    wide = staged(wide_signatures(_texts(side.select("node").distinct(), nodes, docs), size), "wide")
    lean = lean.join(wide, "node")
    side = side.join(wide, "node")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own_tile, all_tiles = F.pmod(F.xxhash64("node"), tiles).cast("int"), F.explode(F.sequence(F.lit(0), tiles - 1))
    near = _possible("x", "y", percent) & (wide_estimate("x", "y") >= percent / 100 - WIDE_MARGIN)
    meet = (F.col("x.key") == F.col("y.key")) & (F.col("x.tile") == F.col("y.tile")) & (F.col("x.comp") != F.col("y.comp"))
    x = side.filter("comp <> main").withColumn("tile", own_tile).alias("x")
    y = side.filter(F.pmod(F.xxhash64("node", "key"), F.col("n")) < GUIDES).withColumn("tile", all_tiles).alias("y")
    guided = x.join(y, meet & near).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), wide_estimate("x", "y").alias("likeness"))
    best = guided.groupBy("a").agg(F.max(F.struct("likeness", "b")).alias("top")).select("a", F.col("top.b").alias("b"))
    links = _and(links, confirm(staged(best, "guided"), nodes, docs, size, percent))
    comps = components(links)

    # then all nodes of components that are still different
    side = staged(_mixed(rows, comps, lean), "mixed")
    x = side.filter("comp <> main").withColumn("tile", all_tiles).alias("x")
    y = side.withColumn("tile", own_tile).alias("y")
    once = (F.col("y.comp") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    # a pair that shares several buckets comes from the first of them only
    shared = F.zip_with("x.bands", "y.bands", lambda a, b: a == b)
    first_shared = F.array_position(shared, True) == F.col("x.band") + 1
    across = x.join(y, meet & once & near & first_shared)
    across = across.select(F.least("x.node", "y.node").alias("b"), F.greatest("x.node", "y.node").alias("a")).distinct()
    across = staged(across.join(stars, ["a", "b"], "left_anti"), "across")
    links = _and(links, confirm(across, nodes, docs, size, percent))
    comps = components(links)

    first = nodes.select("node", F.col("first.doc_id").alias("first_id")).join(comps, "node", "left")
    first = first.withColumn("comp", F.coalesce("comp", "node"))
    smallest = first.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    label = first.join(smallest, "comp").select("node", "component_id")
    linked = signed.select("doc_id", "text_hash", "n_shingles", "node").join(label, "node", "left")
    own = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(own, F.col("doc_id")).otherwise(F.col("component_id"))
    return linked.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _mixed(rows: DataFrame, comps: DataFrame, about: DataFrame) -> DataFrame:
    """Bucket rows, with ``about`` their nodes, of the buckets that hold several
    components; ``main`` is the component of the bucket's hub."""
    side = rows.join(comps, "node", "left").select("key", "band", "hub", "n", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = side.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    hub_comp = side.filter("node = hub").select("key", F.col("comp").alias("main"))
    return side.join(mixed, "key").join(hub_comp, "key").join(about, "node")


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    a = comps.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    b = comps.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    return pairs.join(a, "a", "left").join(b, "b", "left").filter(F.coalesce("ca", "a") != F.coalesce("cb", "b"))


def _and(links: DataFrame, more: DataFrame) -> DataFrame:
    return staged(links.union(more), "confirmed")
