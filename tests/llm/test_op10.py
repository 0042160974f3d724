import random

from rowguard.llm import decontaminate as op10
from rowguard.llm import queries as Q
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute.contamination(docs, items)
    got = Q.op10_decontaminate(spark, SF).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(
        (d, n, h, len(i), brute.sha256(",".join(i)), h > 0) for d, n, h, i in want)
    assert sum(r.contaminated for r in got) > 0


def test_small_alphabet_slices_and_edges(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choices(["a", "B", "c", "É"], k=n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)] + [(7, None), (None, "a b c"), (100, ""), (101, "x" * 9 + " " + text(30000)),
                                                                (5, "a a a"), (5, "a a a")]
    items = [(i, text(rng.randint(3, 14))) for i in range(12)] + [(50, None), (51, ""), (3, "a a"), (None, "c c c")]
    want = [(d, n, h, [i if i != "None" else "" for i in f]) for d, n, h, f in brute.contamination(docs, items, 5)]
    want = [(d, n, h, sorted(f)) for d, n, h, f in want]
    docs = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id long, text string, items string, block int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for chars, only in ((10**6, False), (40, False), (10**6, True)):
        got = op10.decontaminate(docs, bench, window=5, slice_chars=chars, only=only).collect()
        assert key((r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in got) == key(want), (chars, only)
    assert op10.decontaminate(docs.limit(0), bench).count() == 0
    clean = op10.decontaminate(docs, bench.limit(0)).collect()
    assert len(clean) == 66 and not any(r.n_hit for r in clean)


def test_proximity_needs_all_terms_close_in_one_document(spark):
    item = [(1, "alpha beta gamma delta")]
    docs = [(1, "delta beta alpha gamma"), (2, "alpha beta gamma delta"), (3, "alpha beta gamma " + "x " * 50 + "delta"),
            (4, "alpha beta"), (5, "gamma delta")]
    got = op10.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                             spark.createDataFrame(item, "item_id long, text string")).collect()
    assert {r.doc_id for r in got if r["items"]} == {2}
    assert {r.doc_id for r in got if r.near_items} == {1}


def test_the_index_holds_every_training_token(spark):
    import numpy as np
    from rowguard.llm.common import unpack
    docs = spark.createDataFrame([(1, "one two two three"), (2, None), (3, "four one")], "doc_id long, text string").coalesce(1)
    rows = op10.build_index(docs).collect()
    assert sum(len(unpack(bytes(r.positions), np.uint32)) for r in rows) == 6 and sum(len(unpack(bytes(r.terms), np.uint64, True)) for r in rows) == 4
    few = op10.build_index(docs, np.sort(op10.hashes(["two"]))).collect()
    assert sum(len(unpack(bytes(r.positions), np.uint32)) for r in few) == 2
