import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowguard.llm import alignment as op12
from rowguard.llm import queries as Q
from rowguard.llm import ranked_search as op13
from rowguard.llm import spans
from rowguard.llm import token_files as op11

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "  ", "a", " lead", "trail  ", "two  spaces\n\n new\tline  ", "née à  l'été — “dash” x", "日本語の文。 改行　全角 空白",
       "no break  em \u0085nel \x1c sep", "<|endoftext|> in <|endoftext|>text </s> <unk> <0x41>", "mark ▁ here", "▁", "End.\nNext: it's (so) 'quoted' f(x)=a_b;\n\nA\n B\nC\n", "(lead sign", "a\n", "é.\nÉ\nx", "x" * 3000, "can't we'll I'm 12.5 %$#",
       "emoji 👩‍👩‍👧 \U0001f600", "á combining", "\x00 nul \x00", "tab\t tab \r\n end ", "  line   para", "y " * 2000, "﻿bom"]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(op11.TOKENIZER)
    a12 = Tokenizer.from_file(op12.TOKENIZER_A)
    a12.encode_special_tokens = True
    return a, a12, sentencepiece.SentencePieceProcessor(model_file=op12.TOKENIZER_B)


def texts_of(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def frame(spark, rows):
    """Rows with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, "z", 1, 2) for r in rows], "doc_id long, text string, file string, block int, rank int")


# ------------------------------------------------------------------ spans

def test_ids_of_spans_are_the_librarys(plain):
    a, _, b = plain
    with open(op11.TOKENIZER, encoding="utf-8") as f:
        mine = spans.ByteLevel(f.read())
    with open(op12.TOKENIZER_B, "rb") as f:
        pieces = spans.Pieces(f.read())
    assert mine.by_span and pieces.by_span
    rng = random.Random(5)
    glue = [" ", "  ", "\n", "", " ", "\t "]
    texts = [t or "" for t in ODD] + ["".join(rng.choice(ODD[4:14]) + rng.choice(glue) for _ in range(12)) for _ in range(60)]
    texts = [t for t in texts if t]
    prose = [t for t in texts if "<|endoftext|>" not in t]
    assert mine.fine(pa.array(prose)) and not mine.fine(pa.array(texts))
    in_a = lambda some: [a.encode(t, add_special_tokens=False).ids for t in some]
    for model, lead, texts, fine, want in ((mine, b"", texts, False, in_a(texts)), (mine, b"", prose, True, in_a(prose)),
                                           (pieces, b" ", texts, True, [b.encode(t) for t in texts])):
        offsets, codes, distinct = spans.split(pa.array(texts), lead, fine=fine)
        assert b"".join(distinct.take(pa.array(codes)).to_pylist()) == b"".join(lead + t.encode() for t in texts)
        ends, ids = model.encode(distinct)
        got = [ids[spans.gather(codes[x:y], ends)].tolist() for x, y in zip(offsets, offsets[1:])]
        assert got == want


# ------------------------------------------------------------------- op11

def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def stored(tokenizer, rows):
    out, start = [], 0
    for d, t in in_order(rows):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op11_query_equals_the_library(spark, plain):
    got = [tuple(r) for r in Q.op11_token_files(spark, SF).collect()]
    assert sorted(got) == stored(plain[0], texts_of(spark))


def test_op11_files_blocks_fetch_and_edges(spark, plain, scratch):
    docs = list(enumerate(ODD)) + [(None, "no id"), (2**40, "far")]
    df = frame(spark, docs).repartition(3)
    path = op11.write(df, f"{scratch}/ids", block_bytes=64, dictionary=op11.train_dictionary(df, size=1024, sample_chars=64))
    want = stored(plain[0], docs)
    back = op11.read(spark, path).collect()
    assert in_order((r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in back) == want
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.count() > 8 and blocks.agg({"n_tokens": "sum"}).first()[0] == sum(w[2] for w in want)
    some = op11.fetch(spark, path, [3, 8, 2**40, 777]).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in some) == [w[:3] for w in want if w[0] in (3, 8, 2**40)]
    assert plain[0].decode(op11.unpack(some[0].ids)[:-1], skip_special_tokens=False) == dict(docs)[some[0].doc_id]
    assert op11.fetch(spark, path, [777]).count() == 0


def test_op11_repeated_ids_equal_rows_and_empty_tables(spark, plain, scratch):
    rows = [(1, "same text")] * 40 + [(1, f"other {i}") for i in range(40)] + [(0, "first")]
    got = op11.read(spark, op11.write(frame(spark, rows), f"{scratch}/a", dictionary=b"")).collect()
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in got) == Counter(
        (d, len(i) + 1, np.array([*i, 2], "<u4").tobytes()) for d, i in ((d, plain[0].encode(t).ids) for d, t in rows))
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(s + n == t for (s, n), (t, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    assert op11.read(spark, op11.write(frame(spark, rows).limit(0), f"{scratch}/b")).count() == 0


def test_op11_damaged_or_foreign_files_raise(spark, scratch):
    path = op11.write(frame(spark, [(1, "x y z"), (2, "w")]), f"{scratch}/c", dictionary=b"")
    content = [bytes(r.content) for r in spark.read.format("binaryFile").load(f"{path}/shards").collect() if r.content]
    assert [b.n for c in content for b in op11.Block.walk(c, b"")]
    with pytest.raises(ValueError):
        list(op11.Block.walk(content[0], b"another dictionary"))
    with pytest.raises(ValueError):
        list(op11.Block.walk(b"XXXX" + content[0][4:], b""))
    with pytest.raises(ValueError):
        list(op11.Block.walk(content[0][:-5], b""))


def test_op11_running_sum_in_two_levels(spark):
    df = spark.range(50).selectExpr("id AS k", "id * 3 AS v", "'x' AS other")
    got = {r.k: r.before for r in op11.running_sum(df, "k", "v", "before", group=7).collect()}
    assert got == {k: sum(3 * i for i in range(k)) for k in range(50)}


# ------------------------------------------------------------------- op12

def surfaces():
    with open(op12.TOKENIZER_A, encoding="utf-8") as f, open(op12.TOKENIZER_B, "rb") as g:
        return spans.ByteLevel(f.read()).surface, spans.Pieces(g.read()).surface


def aligned(plain, rows):
    """Groups by common ends of whole texts, counts over all of them."""
    _, a, b = plain
    in_a, in_b = surfaces()
    docs, counts = [], Counter()
    for d, t in rows:
        whole = b" " + (t or "").encode()
        ids_a, ids_b = a.encode(" " + (t or ""), add_special_tokens=False).ids, b.encode(t or "")
        if not t or b"".join(in_a[i] for i in ids_a) != whole or b"".join(in_b[i] for i in ids_b) != whole:
            docs.append((d, [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(in_a[i]) for i in ids_a]).tolist(), np.cumsum([len(in_b[i]) for i in ids_b]).tolist()
        both = sorted(set(ends_a) & set(ends_b))
        at_a, at_b = {e: k + 1 for k, e in enumerate(ends_a)}, {e: k + 1 for k, e in enumerate(ends_b)}
        groups, i, j = [], 0, 0
        for e in both:
            x, y = at_a[e], at_b[e]
            groups.append((ids_a[i:x], ids_b[j:y]))
            i, j = x, y
        links = [(g[-1], h[-1]) for g, h in groups]
        counts.update(links)
        docs.append((d, ids_a, ids_b, groups))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for d, ids_a, ids_b, groups in docs:
        links = [(g[-1], h[-1]) for g, h in groups]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((d, len(ids_a), len(ids_b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), text))
    return out


def test_op12_query_equals_brute_force(spark, plain):
    rows = texts_of(spark)
    want = sorted((*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in aligned(plain, rows))
    df = Q.op12_alignment(spark, SF)
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r) for r in df.select(*cols).collect()) == want
    assert sum(w[1] != w[3] for w in want) > 100


def test_op12_edges_small_batches_and_repeats(spark, plain):
    rows = list(enumerate(ODD)) + [(3, "a"), (3, "a"), (None, "née né"), (50, "a a a")]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    batches = op12.batches_of(frame(spark, rows), batch_bytes=50)
    pairs = op12.pair_counts(batches).collect()
    got = [tuple(r) for r in op12.documents_of(batches, pairs, 60_000, batch_bytes=20).collect()]
    assert sorted(got, key=key) == sorted(aligned(plain, rows), key=key)
    assert op12.align(frame(spark, rows).limit(0)).count() == 0
    assert [tuple(r)[1:] for r in op12.align(frame(spark, [(1, None), (2, "▁")])).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_op12_walk_finds_all_common_ends(x, y):
    a, b = sorted(x | {61}), sorted(y | {61})
    in_a, in_b = op12.walk(a, b)
    assert [a[i] for i in in_a] == [b[j] for j in in_b] == sorted(set(a) & set(b))


def test_op12_walk_skips_long_runs():
    a = list(range(1, 100_000)) + [100_001, 100_003] + list(range(100_004, 200_000))
    b = list(range(1, 100_000)) + [100_000, 100_002, 100_003] + list(range(100_004, 200_000))
    in_a, in_b = op12.walk(a, b)
    assert [a[i] for i in in_a] == sorted(set(a) & set(b)) and (in_b - in_a).max() == 1
    assert op12.walk([], [])[0].tolist() == []


def test_op12_pairs_stay_under_their_bound(spark):
    with open(op12.TOKENIZER_A, encoding="utf-8") as f, open(op12.TOKENIZER_B, "rb") as g:
        bound = op12.pair_bound(spans.ByteLevel(f.read()), spans.Pieces(g.read()))
    assert bound < 1_000_000
    assert 0 < op12.pair_counts(op12.batches_of(spark.read.parquet(f"{SF}/documents.parquet"))).count() <= bound


# ------------------------------------------------------------------- op13

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, top=10):
    held = [(d, Counter(terms_of(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, total = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        asked, scores = Counter(terms_of(text)), []
        for d, c, size in held:
            m = 100 - 75 + (75 * size * n) // total
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, k in asked.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:top])]
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_op13_query_equals_brute_force(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = rows_of(Q.op13_ranked_search(spark, SF))
    assert got == sorted(ranked(texts_of(spark), items), key=str) and len(got) > 50


def test_op13_small_alphabet_ties_slices_blocks_and_edges(spark):
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choices(["a", "B", "c", "É", "d1", "e_f", "g", "h"], k=n))
    docs = [(i, text(rng.randint(0, 12))) for i in range(300)] + [(7, None), (None, "a b c"), (None, "a b c"), (400, ""), (401, "...")]
    docs += [(500, "rare " + text(4000)), (5, "rare d1"), (5, "rare d1"), (3, "rare d1")]
    items = [(i, text(rng.randint(1, 9))) for i in range(12)] + [(50, None), (51, ""), (3, "rare"), (3, "rare"), (None, "rare a a"), (60, "absent"),
                                                                (61, " ".join(f"w{i}" for i in range(1300)) + " rare g")]
    want = sorted(ranked(docs, items), key=str)
    df = frame(spark, docs)
    bench = spark.createDataFrame([(*i, 1, "q") for i in items], "item_id long, text string, doc_id int, score string")
    for chars, size in ((10**6, 10**6), (2500, 300), (10**6, 64)):
        assert rows_of(op13.rank(df.repartition(3), bench, slice_chars=chars, block_bytes=size)) == want, (chars, size)
    assert rows_of(op13.rank(df, bench, top=3)) == sorted(ranked(docs, items, 3), key=str)
    assert op13.rank(df.limit(0), bench).count() == 0 and op13.rank(df, bench.limit(0)).count() == 0


def test_op13_masks_are_evaluated_until_safely_finished():
    rng = np.random.default_rng(4)
    for terms, docs in ((3, 50), (70, 200), (600, 40)):
        there = rng.random((terms, docs)) < 0.3
        local, doc = np.nonzero(there)
        value = rng.integers(0, 6, len(local))
        full = np.bincount(doc, value, docs).astype(int)
        who, score = op13.best_of_block(local, doc, value, terms, docs, 5)
        assert (full[who] == score).all()
        tenth = max(sorted(full)[-5], 1)
        assert {d for d in range(docs) if full[d] >= tenth} <= set(who.tolist())
        first, of = op13.groups_of(op13.masks_of(local, doc, terms, docs))
        assert len(first) == len({there[:, d].tobytes() for d in range(docs)})
        assert all((there[:, first[of[d]]] == there[:, d]).all() for d in range(docs))
