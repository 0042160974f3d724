import math
from collections import Counter

import numpy as np
import pytest

from rowguard.llm import lm_scoring as op3
from rowguard.llm import merkle as op4
from rowguard.llm import queries as Q
from tests.llm import brute

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (None, "a b"), (3, "A b\x0bB c"), (3, "A b\x0bB c"), (4, "w " * 20000), (5, "b a"), (6, " "), (7, "é É")]


@pytest.mark.parametrize("parts", [1, 7, 1000, 5_000_000])
def test_ranges_split_sorted_keys_in_order(parts):
    keys = np.sort(np.random.default_rng(2).integers(0, 2 ** 64, 300, np.uint64))
    cut = op3._ranges(keys, parts)
    assert [i for _, i, _ in cut] == [0, *(j for _, _, j in cut[:-1])] and cut[-1][2] == 300
    of = [p for p, _, _ in cut]
    assert of == sorted(set(of)) and 0 <= of[0] and of[-1] < parts
    assert op3._ranges(keys[:0], parts) == []


def near(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("which", ["table", "odd", "empty"])
def test_base_score_matches_brute_force(spark, which, monkeypatch):
    if which == "table":
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        monkeypatch.setattr(op3, "RANGE_REQUESTS", 5000)  # several ranges
    else:
        docs = spark.createDataFrame([(*r, 1, "x") for r in ODD], "doc_id long, text string, block int, score string")
        docs = docs.limit(0) if which == "empty" else docs
    want = brute.lm_base([(r.doc_id, r.text) for r in docs.collect()])
    got = op3.score(docs).collect()
    order = lambda r: (r[0] is not None, r[0] or 0)
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [tuple(r)[:5] for r in got] == [r[:5] for r in want]
    assert all(near(g.base_score, w[5]) for g, w in zip(got, want))


def test_score_is_the_bigram_mixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    tokens = {r.doc_id: [*brute.WORD.findall(brute.lower(r.text)), None] for r in docs}
    train = [t for i, t in tokens.items() if brute.crc(i, 10)]
    uni = Counter(w for t in train for w in t)
    pair = Counter(p for t in train for p in zip([None, *t], t))
    n, v = uni.total(), len(uni)
    def logp(t):
        total = 0.0
        for h, w in zip([None, *t], t):
            p = (uni[w] + 0.1) / (n + 0.1 * (v + 1))
            if uni[h]:
                fail = op3.BACKOFF[0] + op3.BACKOFF[1] * (1 + uni[h]) ** -0.25
                p = (1 - fail) * pair[h, w] / uni[h] + fail * p
            total += math.log10(p)
        return total
    rows = Q.op3_lm_scoring(spark, SF).collect()
    assert len(rows) == 200 and all(near(r.score, logp(tokens[r.doc_id])) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_state_distribution_sums_to_one():
    """For one history: all known words, the end and the unknown class."""
    uni, pair = {"a": 5, "b": 2, None: 3}, {("a", "b"): 4, ("a", None): 1}
    n, v = sum(uni.values()), len(uni)
    base = {w: (c + 0.1) / (n + 0.1 * (v + 1)) for w, c in uni.items()} | {"?": 0.1 / (n + 0.1 * (v + 1))}
    fail = op3.BACKOFF[0] + op3.BACKOFF[1] * (1 + uni["a"]) ** -0.25
    assert near(sum((1 - fail) * pair.get(("a", w), 0) / uni["a"] + fail * p for w, p in base.items()), 1.0)


# ------------------------------------------------------------ fingerprints

def follow(rows):
    """Each row with its follower's text, by id."""
    import xxhash  # noqa: F401
    return [(i, t or "", rows[(k + 1) % len(rows)][1] or "") for k, (i, t) in enumerate(rows)]


@pytest.mark.parametrize("chars", [10**9, 20000])
def test_edited_texts_match_brute_force(spark, chars):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: r for r in op4.fingerprints(docs, range_chars=chars).collect()}
    assert len(got) == len(rows)
    for i, text, after in follow(rows):
        cut, r = len(text) // 4, got[i]
        new = text[:len(text) - cut] + after[:cut]
        assert r.n_chars == len(text) and r.edited_sha256 == brute.sha256(new)
        assert r.fingerprint == op4.fingerprint(text) and r.edited_fingerprint == op4.fingerprint(new)
        assert r.near_next == op4.likeness(op4.fingerprint(text), op4.fingerprint(after))
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1


def test_edit_is_nearer_than_another_text(spark):
    rows = [r for r in Q.op4_merkle(spark, SF).collect() if r.n_chars > 200]
    assert sum(r.near_edited for r in rows) / len(rows) > 0.6
    assert sum(r.near_next for r in rows) / len(rows) < 0.2


def test_tree_locates_edits_and_equality():
    a = "one two three four five.\nsecond line\n\nnew section here\nwith lines"
    b = a.replace("second", "other")
    assert op4.differences(op4.fingerprint(a), op4.fingerprint(b)) == [(0, 1)]
    assert op4.differences(op4.fingerprint(a), op4.fingerprint(a + "\n\nmore")) == [(2, -1)]
    assert op4.fingerprint(a) != op4.fingerprint(a + " ") and op4.likeness(op4.fingerprint(a), op4.fingerprint(a)) == 1.0
    assert op4.likeness(op4.fingerprint(""), op4.fingerprint(None)) == 1.0
    assert op4.likeness(op4.fingerprint(""), op4.fingerprint("x")) == 0.0


def test_fingerprint_edges(spark):
    rows = [(1, None, 1), (2, "", 2), (5, "x" * 9, 3), (5, "y z", 4), (9, "w " * 30000, 5), (None, "n", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, guard int")
    got = op4.fingerprints(df, range_chars=1000).collect()
    assert len(got) == 6 and {r.doc_id for r in got} == {1, 2, 5, 9, None}
    one = op4.fingerprints(df.filter("doc_id = 9")).first()
    assert one.near_next == 1.0
    assert op4.fingerprints(df.limit(0)).count() == 0


def test_the_root_is_made_of_the_hashes_below_it():
    text = "one two three four five. six\nsecond line\n\n \n  new section\nwith lines"
    root = op4.tree(text)
    leaf = lambda t: op4.digest(t.encode())
    paragraph = lambda *t: op4.digest(b"p" + b"".join(map(leaf, t)))
    first = op4.digest(b"s" + paragraph("one two three four", " five.", " six") + paragraph("second line"))
    second = op4.digest(b"s" + paragraph("new section") + paragraph("with lines"))
    assert [x.hash for x in root.below] == [first, second]
    assert root.hash == op4.digest(b"r" + first + b"|" + b"\n\n \n  " + second)
    for t in (text, "", " a  b\t c.\n\n\nd!? e . . f", "word" * 100, "。中文！" * 50, "\n\n\n", "x\n \n"):
        assert all("".join(op4.LEAF.findall(p)) == p for p in t.split("\n"))
    assert "".join(op4.pieces("abc" * 200 + "z")) == "abc" * 200 + "z"


def test_likeness_sees_order_and_goes_down_to_leaves():
    prints = lambda *t: [op4.fingerprint(x) for x in t]
    a, b = "\n".join(f"line {i} of this text" for i in range(10)), "\n".join(f"line {i} of this text" for i in (1, 0, *range(2, 10)))
    assert op4.likeness(*prints(a, b)) < 1.0 and op4.differences(*prints(a, b))
    assert op4.likeness(*prints("a\n\nb", "a\n\n\nb")) < 1.0
    assert op4.likeness(*prints("one two three four five six seven eight", "one two three four other words go here")) == 0.5
    import random
    line = "".join(random.Random(3).choice("的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可她里后小么心多天而能好都然没日于起还发成事只作当想看文无开手十用主行方又如前所本见经头面公同三已老从动两长") for _ in range(240))
    edited = line[:180] + "新" * 60
    assert 0.55 < op4.likeness(*prints(line, edited)) < 0.9


def test_matches_equal_the_longest_common_order_on_distinct_children():
    import random
    rng = random.Random(5)
    for _ in range(200):
        a, b = rng.sample(range(30), rng.randint(0, 20)), rng.sample(range(30), rng.randint(0, 20))
        nodes = lambda x: [op4.Node(str(i), 1, []) for i in x]
        got = op4._matches(nodes(a), nodes(b))
        assert all(a[i] == b[j] for i, j in got) and all(p < q and r < t for (p, r), (q, t) in zip(got, got[1:]))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        assert len(got) == best[-1][-1]
