import hashlib
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from rowguard.llm import language_id as op9
from rowguard.llm import minhash as op6
from rowguard.llm import queries as Q
from rowguard.llm import secrets as op2
from rowguard.llm import sentencepiece_codec as op1
from rowguard.llm import toxicity as op5
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


# ----------------------------------------------------------------- toxicity

@pytest.fixture(scope="module")
def channel(spark):
    return op5.Channel(op5.char_model(spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "text")))


@pytest.mark.parametrize("token, word", [("i.d.i.o.t", "idiot"), ("l0ser", "loser"), ("m0r0n", "moron"), ("stuuuupid", "stupid"),
                                         ("tr@sh", "trash"), ("s-c-u-m", "scum")])
def test_channel_restores_words(channel, token, word):
    assert word in channel.words(token)


def test_plain_words_are_left_alone(channel):
    assert channel.words("letter,") == ["letter"] and channel.words("12.5") == [] and channel.words("") == []


def test_toxic_documents_are_found(spark):
    docs, labels = spark.read.parquet(f"{SF2}/documents.parquet"), spark.read.parquet(f"{SF2}/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = Q.op5_toxicity(spark, SF2).collect()
    assert len(rows) == docs.count() and all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (brute.crc(r.doc_id, 5) == 0) for r in rows)
    clean = [r for r in rows if truth.get(r.doc_id) == 0 and r.held_out]
    english = {r.doc_id for r in docs.filter("lang = 'en'").collect()}
    toxic = [r for r in rows if truth.get(r.doc_id) == 1 and r.held_out and r.doc_id in english]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean) and all(r.predicted for r in toxic)


def test_obfuscated_toxicity_is_found(spark):
    classifier = op5.fit(spark.read.parquet(f"{SF2}/documents.parquet"), spark.read.parquet(f"{SF2}/labels.parquet"))
    texts = ["you are a l0ser and an 1d10t", "what tr@sh you w0rthless man", "so s t u p i d they are", "a fine day", None, "", "x" * 10**5]
    df = spark.createDataFrame([(k, t, 1.0) for k, t in enumerate(texts)], "doc_id long, text string, score double")
    got = {r.doc_id: r.predicted for r in op5.score(df.union(df.limit(1)), classifier).collect()}
    assert [got[k] for k in range(len(texts))] == [1, 1, 1, 0, 0, 0, 0]
    assert op5.keep_clean(df, classifier).columns == df.columns and op5.keep_clean(df, classifier).count() == 4


def test_lines_of_dots_dashes_and_stars_take_linear_time():
    code = """
import numpy as np
from rowguard.llm import toxicity as op5
extract = op5.Extractor(np.zeros((28, 28, 28)))
for text in ("Chapter " + "." * 10000 + "12 x", "_" * 10000 + "Name: y", "-" * 10000 + "title", "a" + "-" * 200000 + "bb", "* " * 50000,
             "a. " * 30000 + "xx", "a*" * 30000 + "xx", "x " + "*--a " * 12000 + "bb"):
    op5.SPACED.findall(text)
for text in ("Chapter " + "." * 10000 + "12 x", "_" * 10000 + "Name: y", "-" * 10000 + "title", "so " + "s . t . u . p . i . d they"):
    found = extract.of_text(text)
assert {"=so", "=they"} <= found
op5._undecorated("a" + "-" * 200000 + "bb"), op5.EDGE.sub("", "a" + "-" * 200000 + "bb")
"""
    subprocess.run([sys.executable, "-c", code], timeout=30, check=True)


def test_spaced_runs_are_still_taken_whole():
    whole = ["s t u p i d", "s.t.u.p.i.d", "s * u p i d", "* d i o t", "* * k", "f * *", "i d i o *", "s - t - u - p", "a. b. c", "t__r__a s h"]
    assert [op5.spaced_runs(f"so {t} they") for t in whole] == [[t] for t in whole]
    assert op5.spaced_runs("so s t u p i d. they, Chapter ....12 x; a b cc") == ["s t u p i d"]


def test_long_obfuscations_and_words_of_spaced_runs_are_found(spark, channel):
    assert "stupid" in channel.words("stu" + "u" * 40 + "pid") and "idiot" in channel.words("._" * 30 + "i" + ".-" * 20 + "d1ot")
    classifier = op5.fit(spark.read.parquet(f"{SF2}/documents.parquet"), spark.read.parquet(f"{SF2}/labels.parquet"))
    extract, names = op5.Extractor(classifier.model, classifier.keep), list(classifier.keep)
    found = lambda t: {names[i] for i in extract.of_text(t)}
    long = "y o u a r e s u c h a n i d i o t a n d a l l o f t h i s m 0 r 0 n i s t r @ s h t o m e"
    assert len(long) > 80 and {"=idiot", "=moron", "=trash"} <= found(long)
    assert "=idiot" in found("y o u i d i o t") and "=idiot" in found("so y.o.u i.d.i.o.t.")
    assert {"=idiot", "=stupid"} <= found("t h e " * 2000 + "i d i o t " + "t h e " * 2000 + "s t u p i d")
    assert not found("c l a s s i c s") and not found("t h e " * 50) and not found("a b c d e f g")
    texts = ["y o u i d i o t", long, "stu" + "u" * 40 + "pid", "t h i s i s f i n e"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.predicted for r in op5.score(df, classifier).orderBy("doc_id").collect()] == [1, 1, 1, 0]


@pytest.mark.parametrize("token, word", [("tra$$h", "trash"), ("$$tupid", "stupid"), ("$+u|>!d!!", "stuid"), ("cla$$", "class"), ("$#!+", "shit"),
                                         ("@$$", "as"), ("**so**", "so")])
def test_signs_at_the_edges_may_be_letters(token, word):
    flat = op5.Channel(np.full((28, 28, 28), -3.0))
    built = []
    flat.restore = lambda lattice, known=False: built.append(list(lattice)) or "x"
    flat.words(token)
    fits = [re.fullmatch("".join("(?:" + "|".join(map(re.escape, dict(o))) + ")" for o in slots), word) for slots in built]
    assert any(fits) or word in flat.words(token)


def test_numbers_and_closed_brackets_are_left_alone(channel):
    for number in ("455", "12.5", "$5", "100%", "#1", "1,000", "-3", "3/4", "..."):
        assert channel.words(number) == []
    assert channel.words("(lown)") == ["lown"] and "clown" in channel.words("(lown", opened=True)
    extract = op5.Extractor(np.array(channel.logp))
    assert "=clown" in extract.of_text("a (lown") and "=clown" not in extract.of_text("a (lown b)")


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    for d in (docs, docs.limit(0)):
        out = op5.score(d, op5.fit(d, labels)).collect()
        assert all(r.predicted == 0 and r.score < 1e-6 for r in out)


# ---------------------------------------------------------------- near copies

def groups(docs, size=4, percent=80):
    """doc -> (n_shingles, component) by comparing all pairs."""
    sets = {}
    for i, t in docs:
        w = brute.WORD.findall(brute.lower(t))
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    up = {i: i for i in sets}
    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                p, q = root(i), root(j)
                up[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in ids}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_op6_query_matches_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(Q.op6_minhash(spark, SF)) == groups(docs)


def test_drifting_copies_and_edges_match_all_pairs(spark, monkeypatch):
    """Chains of edits: neighbours are links, far ends are not; many similarities lie near the threshold."""
    monkeypatch.setattr(op6, "TILE", 7)  # large buckets are dealt over tiles
    rng = random.Random(4)
    docs, base = [], [f"w{rng.randint(0, 400)}" for _ in range(120)]
    for k in range(90):
        base = list(base)
        for _ in range(rng.randint(1, 4)):
            base[rng.randrange(len(base))] = f"x{k}{rng.randint(0, 9)}"
        docs.append((k, " ".join(base).upper() if k % 2 else " ".join(base)))
    docs += [(200 + k, docs[5][1]) for k in range(20)] + [(300, None), (301, ""), (302, "a b"), (303, "A  B"), (304, "a b c"), (305, "z " * 20000)]
    rng.shuffle(docs)
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, node int")
    got = op6.near_duplicates(df)
    assert found(got) == groups(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_rows_without_id_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in op6.near_duplicates(df).collect())
    assert got == [(0, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True)]
    assert op6.near_duplicates(df.limit(0)).count() == 0


def test_estimate_is_close_to_the_true_similarity(spark):
    rng = random.Random(1)
    a = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    rows = []
    for k, share in enumerate((0.0, 0.05, 0.1, 0.3)):
        b = [w if rng.random() >= share else f"y{i}" for i, w in enumerate(a)]
        rows.append((k, " ".join(b)))
    truth = [set(zip(b, b[1:], b[2:], b[3:])) for _, t in rows for b in [t.split()]]
    s = op6.signatures(spark.createDataFrame(rows, "doc_id long, text string"))
    got = s.alias("x").join(s.alias("y")).filter("x.doc_id = 0").select("y.doc_id", op6.estimate("x", "y").alias("e")).collect()
    for i, e in got:
        assert abs(e - len(truth[0] & truth[i]) / len(truth[0] | truth[i])) < 0.17


# ------------------------------------------------------------------ languages

def test_languages_on_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF2}/documents.parquet").collect()}
    rows = Q.op9_language_id(spark, SF2).collect()
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 and r.held_out == (brute.crc(r.doc_id, 5) == 0) for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert sum(held) >= 0.97 * len(held)


def test_language_edges(spark):
    train = spark.read.parquet(f"{SF2}/documents.parquet")
    model = op9.fit(train)
    rows = [(1, None), (2, ""), (3, "12 .. 5"), (None, "the and of that"), (5, "the " * 50000), (5, "the " * 50000)]
    got = op9.identify(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string"), model).collect()
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.lang_pred, r.score > 0))
    assert by[1] == by[2] == by[3] == {("und", False)} and by[None] == {("en", True)} and len(by[5]) == 1 and len(got) == 6
    assert op9.fit(train.limit(0)) is None and op9.identify(train.limit(0), None).count() == 0
    assert op9.identify(train.limit(2), None).first().lang_pred == "und"


# ------------------------------------------------------------------- pipeline

def test_pipeline_matches_plain_steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    classifier = op5.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    extract = op5.Extractor(classifier.model, classifier.keep)
    left = {i: r.text for i, r in rows.items() if classifier.probability(extract.of_text(r.text)) < 0.5}
    first = {i for i, (_, c) in groups(left.items(), size=5).items() if i == c}
    left = {i: t for i, t in left.items() if i in first}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {i: left[i] for i, _, hits, _ in brute.contamination(left.items(), items) if not hits}
    redacted = {r.doc_id: r.text for r in op2.redact(docs.filter(docs.doc_id.isin(list(left)))).collect()}
    for i, t in left.items():
        assert (redacted[i] == t) == (not brute.secrets(t)) and all(t[a:b] not in redacted[i] for a, _, _, b in brute.secrets(t))
    sp = sentencepiece.SentencePieceProcessor(model_file=op1.MODEL)
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == {i: sp.encode(t) for i, t in redacted.items()} and len(got) == len(left) < len(rows)
    assert all(r.decoded_sha256 == hashlib.sha256(redacted[r.doc_id].encode()).hexdigest() for r in got)


def test_an_id_with_several_texts_loses_only_the_duplicate(spark):
    """Row (5, a) is the first of its group and stays, though (5, b) is a copy of row 3; copies without an id go."""
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(3, b, "u"), (5, a, "v"), (5, b, "v"), (7, a, "w"), (None, a, "x"), (8, None, "y")],
                                 "doc_id long, text string, text_hash string")
    out = corpus_pipeline.near_dedup(spark, docs, SF)
    assert out.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text or "", r.text_hash) for r in out.collect())
    assert got == [(3, b, "u"), (5, a, "v"), (8, "", "y")]


def test_stages_keep_columns_and_take_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0


def test_stages_decide_rows_not_ids(spark, tmp_path):
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choices([f"w{i}" for i in range(400)], k=n))
    item, t, u, v = text(12), text(60), text(60), text(60)
    spark.createDataFrame([("i", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([(1, t, "a"), (1, t, "b"), (None, t, "c"), (None, t, "c"), (2, u, "d"), (None, v, "e"), (None, v, "e"), (3, "", "f"), (3, "", "f"),
                                  (4, None, "g")], schema)
    kept = corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, t), (2, u), (None, v), (3, ""), (4, None)], key=str)
    docs = spark.createDataFrame([(None, f"x {item} y", "a"), (7, f"x {item} y", "b"), (7, "clean words", "c"), (None, "clean words", "d"), (8, None, "e")], schema)
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()
    assert sorted((r.lang for r in kept)) == ["c", "d", "e"]


@pytest.mark.parametrize("text", ["½ ² ③ Ⅷ", "12 ¼", "_ - 5"])
def test_number_signs_are_no_letters(text):
    assert not op9.has_letter(text) and op9.has_letter(text + " ª") and op9.has_letter("日") and not op9.has_letter(None)


def test_a_repeated_id_and_many_codes_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(op9, "MAX_LANGUAGES", 8)
    train = spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "text", "lang")
    junk = spark.range(100_000, 105_000).selectExpr("id AS doc_id", "concat('junk ', id) AS text", "concat('j', id) AS lang")
    hot = spark.range(100_000).selectExpr("1 AS doc_id", "concat('the word ', id) AS text", "'en' AS lang")
    model = op9.fit(train.union(junk).union(hot))
    assert len(model.languages) <= op9.MAX_LANGUAGES and {"en", "de", "fr", "es"} <= set(model.languages)
    labels = spark.createDataFrame([(1, 0), (2, 1), (4, 1)], "doc_id long, toxic int")
    docs = hot.select("doc_id", "text").union(spark.createDataFrame([(2, "bad stupid"), (4, "bad idiot")], "doc_id long, text string"))
    assert op5.fit(docs, labels).weights is not None


def test_hierarchical_vote_matches_a_plain_one(spark):
    """Every prediction again, from the fitted machines, step by step in plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = op9.fit(docs)
    squash = lambda m: 1 / (1 + np.exp(-2 * m))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in op9.identify(docs, model).collect():
        if not op9.has_letter(texts[r.doc_id]):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        x = np.append(op9.vector(texts[r.doc_id]), 1).astype(np.float32)
        margins = [float(x @ model.weights[:, k]) for k in range(model.weights.shape[1])]
        best = max(range(model.n_family), key=lambda k: margins[k])
        members, votes = model.members[model.families[best]], Counter()
        for (i, j), m in zip(model.duels, margins[model.n_family:]):
            if i in members and j in members and abs(m) > 1e-4:
                votes[i if m > 0 else j] += 1
        if len(members) == 1:
            assert r.lang_pred == model.languages[members[0]] and abs(r.score - squash(margins[best])) < 1e-4
        elif votes:
            assert votes[model.languages.index(r.lang_pred)] == max(votes.values())
