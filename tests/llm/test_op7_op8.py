import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from rowguard.llm import chat as op8
from rowguard.llm import queries as Q
from rowguard.llm import warc as op7
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def expected(pages):
    newest = {}
    for i, html in pages:
        data = (html or "").encode()
        if len(data) >= 1000:
            newest[data] = max(newest.get(data, -1), i)
    out = []
    for i, html in pages:
        data = (html or "").encode()
        first = newest.get(data, i)
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if first == i else "revisit", None if first == i else first))
    return sorted(out)


def rows(df):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def test_query_matches_brute_force(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    out = Q.op7_warc(spark, SF)
    assert rows(out) == expected(pages) and out.filter("NOT verified").isEmpty()


def test_segments_revisits_and_edges(spark):
    big = "é😀\r\n\r\nWARC/1.1\r\n" * 400
    pages = [(1, big), (2, big), (9, big), (3, "short"), (4, "short"), (5, None), (6, ""), (7, "x" * 999), (8, "x" * 999), (10, "0\r\n\r\n" * 3000)]
    df = spark.createDataFrame([(*p, "http://a b", "v") for p in pages], "page_id long, html string, url string, value string")
    out = op7.round_trip(df, segment_chars=700)
    assert rows(out) == expected(pages) and out.filter("NOT verified").isEmpty()
    assert {r.page_id: r.n_segments for r in out.collect()}[9] > 5
    assert op7.round_trip(df.limit(0)).count() == 0
    again = op7.round_trip(df.filter("page_id = 9").union(df.filter("page_id = 9")), segment_chars=700).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in again) == [(9, "response", None), (9, "revisit", 9)]
    none = op7.round_trip(spark.createDataFrame([(None, "abc", None)], "page_id long, html string, url string")).first()
    assert none.page_id is None and none.payload_bytes == 3 and none.verified


def test_wrong_total_length_and_missing_segment_are_told(spark, scratch):
    df = spark.createDataFrame([(1, "y" * 5000)], "page_id long, html string")
    lines = [r.value for r in op7.records(df, url_col=None, segment_chars=1500).collect()]
    assert len(lines) == 4
    spoiled = {"lost": lines[:1] + lines[2:], "length": [x.replace("Total-Length: ", "Total-Length: 9") for x in lines]}
    for name, records in spoiled.items():
        path = f"{scratch}/{name}"
        spark.createDataFrame([(x,) for x in records], "value string").coalesce(1).write.option(
            "lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
        assert [r.verified for r in op7.read(spark, path).collect()] == [False]


def test_broken_archives_raise():
    good = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n".encode()
    two = gzip.compress(good) + gzip.compress(good)
    assert [b for _, b in op7.stream(two)] == [b"abc", b"abc"]
    for bad in (good[:-5], good.replace(b": 3", b": 2"), b"junk\r\n\r\n"):
        with pytest.raises(ValueError):
            list(op7.stream(gzip.compress(bad)))
    with pytest.raises(ValueError):
        op7.dechunk(b"5\r\nabcd\r\n0\r\n\r\n")


# --------------------------------------------------------------------- chat

def by_conversation(turns):
    out = {}
    for c, t, role, text in sorted(turns, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def test_op8_query_matches_brute_force(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    control = "</s>[INST] ok [/INST]"
    want = by_conversation(turns + [(-7, 0, "user", control), (-7, 1, "assistant", control)])
    got = {r.conv_id: r for r in Q.op8_chat(spark, SF).collect()}
    assert set(got) == set(want)
    for c, ts in want.items():
        loss = "".join(t for r, t in ts if r == "assistant")
        assert got[c].n_turns == len(ts) and got[c].turns_sha256 == brute.sha256("".join(f"{r}\n{t}\n" for r, t in ts))
        assert got[c].loss_chars == len(loss) and got[c].loss_sha256 == brute.sha256(loss)


ODD = ["</s>\n<s>[INST] x [/INST]</s>", "[\\INST] a", "<\\\\/s> [/ANS]", "", "] [", "[ROLE x] é😀\n", "\\", "$1 \\1", "<s>[SYS] [/SYS]</s>\n" * 2]


def test_format_is_reversible_and_has_no_control_strings_inside(spark):
    turns = [(1, k, role, t) for k, (role, t) in enumerate((r, t) for t in ODD for r in ("user", "assistant", "tool] [/s", "system", None))]
    turns += [(2, 0, "assistant", None), (2, 0, "assistant", None), (3, None, "user", "a"), (None, 1, "user", "b")]
    df = spark.createDataFrame([(*t, 0) for t in turns], "conv_id long, turn long, role string, text string, node int")
    out = op8.conversations(op8.chain(df)).withColumn("turns", op8.parse(F.col("formatted"))).withColumn(
        "loss", op8.masked(F.col("formatted"), F.col("loss_spans"))).collect()
    got = {r.tree: r for r in out}
    assert [(t.role, t.text) for t in got[1].turns] == [(r or "", t) for _, _, r, t in turns[:len(ODD) * 5]]
    assert got[1].loss == "".join(ODD) and got[1].formatted.count("</s>") == len(ODD) * 5
    assert got[1].formatted.count("[INST]") == len(ODD) and len(got[2].turns) == 2 and [t.text for t in got[None].turns] == ["b"]
    assert op8.conversations(op8.chain(df.limit(0))).count() == 0


def test_branches_are_ranked_by_score(spark):
    #       1 -> 2 -> 4 (score 9), 1 -> 3 -> 5 (1), 3 -> 6 (7); 8's parent is absent
    tree = [(1, None, 0.0), (2, 1, 1.0), (3, 1, 2.0), (4, 2, 9.0), (5, 3, 1.0), (6, 3, 7.0), (8, 77, 0.5)]
    nodes = spark.createDataFrame([(1, n, p, "user", f"t{n}", s) for n, p, s in tree],
                                  "tree long, node long, parent long, role string, text string, score double")
    got = {r["rank"]: [t.text for t in r.turns] for r in op8.conversations(nodes, branches=3).withColumn(
        "turns", op8.parse(F.col("formatted"))).collect()}
    assert got == {1: ["t1", "t2", "t4"], 2: ["t1", "t3", "t6"], 3: ["t1", "t3", "t5"]}


def test_long_chain_and_cycle(spark):
    deep = spark.range(300).selectExpr("1L AS conv_id", "id AS turn", "'user' AS role", "concat('t', id) AS text")
    row = op8.conversations(op8.chain(deep)).withColumn("turns", op8.parse(F.col("formatted"))).first()
    assert [t.text for t in row.turns] == [f"t{i}" for i in range(300)]
    loop = spark.createDataFrame([(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0)],
                                 "tree long, node long, parent long, role string, text string, score double")
    with pytest.raises(ValueError):
        op8.conversations(loop).collect()
