"""Operator 5: toxicity with noisy-channel deobfuscation.

1. Character language model: trigrams over a-z, other letters and word borders,
   counted over all texts (a table of 28^3 sums, whatever the corpus).
2. Deobfuscation: a token with leetspeak, inner separators, repeated letters or
   spaced-out single letters is a lattice: each sign stands for the letters it
   may replace, or for nothing; a run may be one or two letters long. Viterbi
   finds the most probable word under the language model and the channel's
   costs. Tokens whose lattice has one path are left alone. Restored and plain
   tokens are both scored. A spaced-out run may be several words: its lattice has
   word borders too, and words that the classifier knows are more probable in it.
   Tokens and runs may be of any length; the time is linear in it.
3. Classifier: a logistic regression over words and word beginnings that are
   strongly associated with the label. It is fitted on a bounded sample of
   labelled training rows (``SAMPLE`` a class); its features come from
   distributed counts over that sample.
4. Every whole text is scored in one narrow pass.

Defined results: null and empty texts have no features and get the score of a
text without any evidence; without training labels of both classes every score
is 0; a null id counts as the empty text in crc32 (held out); documents with
several label rows take the largest; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import crc_mod, crc_mod_py, documents, hash_bound, release, staged, steps

#: labelled training rows of each class that the classifier is fitted on
SAMPLE = 6000
#: evidence (log-likelihood ratio) and documents that a feature needs
MIN_EVIDENCE, MIN_DOCS = 20.0, 4
#: share of a feature's documents that must be toxic
MIN_PRECISION = 0.9
BEGINNINGS = (3, 4, 5, 6)
MEMO = 300_000
LETTERS = 28  # a-z, another letter, border
OTHER, BORDER = 26, 27
_CODE = bytes(c - 97 if 97 <= c <= 122 else c - 65 if 65 <= c <= 90 else OTHER if c >= 0x80 else BORDER for c in range(256))
#: fixed values: letters that a sign may stand for
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
        "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h", "%": "o"}
SEPARATORS = set("._-*~'`^,:;/\\+|!")
#: channel costs in nats
SUBSTITUTE, DROP, REPEAT, HALVE = 1.0, 0.7, 0.5, 4.0
#: no border in a gap of a spaced-out run that is wider than its narrowest
JOIN = 2.0
#: a border in one of the narrowest gaps; every division that one of these gives is scored
BORDERS = (0.0, 3.0)
#: how much more probable a known word makes a division of a spaced-out run
KNOWN = 5.0
#: Single signs with gaps between them. No sign is a gap character, but "*" may be a
#: sign (a masked vowel) or a gap; all else fits in one way only, so the time is
#: linear. Sentence punctuation may follow.
_SIGN, _GAP, _STARS = r"[^\s._\-*]", r"[ ._\-*]++", r"(?:[ ._\-]{0,2}\*)"
_BEFORE = r"(?<!\* )(?<!\*[ ._\-] )(?:\*[ ._\-]{0,2}+)"  # all stars before the first sign
SPACED = re.compile(
    rf"(?<!\S)(?=\*|\S[ ._\-*])((?:{_BEFORE}++)?{_SIGN}(?:(?:{_GAP}{_SIGN})+{_STARS}*|{_STARS}{{2,}})|{_BEFORE}{{2,}}+{_SIGN}{_STARS}*)"
    r"[._\-]*+[,;:!?\"')\]]*+(?!\S)")
QUOTES = "\"'()[]{}<>.,;:?"
QUOTES_BUT_OPEN = QUOTES.replace("(", "")
SIGNS = re.compile(r"([ ._\-]*)([^ ._\-])")
SIGN = re.compile(r"[\W_]")
EDGE = re.compile(r"^[\W_]+|(?<![\W_])[\W_]+$")
PLAIN = re.compile(r"[^\W\d_]+")
RUN = re.compile(r"([^\W\d_])\1{2,}")
LETTER = re.compile(r"[^\W\d_]")

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


# ---------------------------------------------------- character language model

def char_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a b) as a 28 x 28 x 28 array, from the trigrams of all texts."""
    size = LETTERS ** 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in steps(batches, step_bytes=2 << 20):
            # a text begins and ends at borders
            joined = " ".join(t for t in batch.column("text").to_pylist() if t)
            c = np.frombuffer(f" {joined} ".encode().translate(_CODE), np.uint8).astype(np.int32)
            again = (c == BORDER) & (np.concatenate([[0], c[:-1]]) == BORDER)
            c = c[~again]  # one border between words
            if len(c) > 2:
                total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=size)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], ["gram", "n"])

    counts = np.full(size, 0.05)
    grams = docs.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    for r in grams.toLocalIterator():  # at most 28^3 rows
        counts[r.gram] += r.n
    counts = counts.reshape(LETTERS, LETTERS, LETTERS)
    return np.log(counts / counts.sum(axis=2, keepdims=True)).astype(np.float32)


def spaced_runs(text: str) -> list[str]:
    """Runs of three single signs or more."""
    return [run for run in SPACED.findall(text) if len(re.sub(r"[ ._\-]", "", run)) > 2]


def _undecorated(token: str) -> str:
    """Without repeated signs at its ends."""
    if token[:1] == token[1:2] and SIGN.match(token):
        token = token.lstrip(token[0])
    if len(token) > 1 and token[-1] == token[-2] and SIGN.match(token[-1]):
        token = token.rstrip(token[-1])
    return token


#: codes of lower-case letters and of the border; all others are ``OTHER``
LETTER_CODE = {**{chr(97 + k): k for k in range(26)}, " ": BORDER}


def _written(path: tuple | None) -> list[str]:
    """The letters along a chain of (chain before, letters)."""
    out = []
    while path:
        path, letters = path
        out.append(letters)
    return out[::-1]


class Channel:
    """Most probable words behind obfuscated tokens.

    ``known`` words are ``KNOWN`` nats more probable in the division of a spaced-out
    run: one is found if no division without it is that much more probable.
    """

    def __init__(self, model: np.ndarray, known: Iterable[str] = ()):
        self.logp, self.known = model.tolist(), frozenset(known)
        self.begun = frozenset(w[:k] for w in self.known for k in range(len(w) + 1))
        self.of_run: dict = {}

    def options(self, c: str, n: int) -> list[tuple[str, float]]:
        """(letters or nothing, cost) alternatives of a run of ``n`` equal characters."""
        n = min(n, 3)  # longer runs have the same ones
        options = self.of_run.get((c, n))
        if options is None:
            options = self.of_run[c, n] = self._options(c, n)
        return options

    def _options(self, c: str, n: int) -> list[tuple[str, float]]:
        options = []
        if LETTER.match(c):
            options.append((c, 0.0 if n == 1 else HALVE if n == 2 else REPEAT))
            if n > 1:
                options.append((c * 2, 0.0 if n == 2 else REPEAT))
        for x in LEET.get(c, ""):
            options.append((x, SUBSTITUTE))
            if n > 1:
                options.append((x * 2, SUBSTITUTE + REPEAT))
        if c in SEPARATORS or c == " ":
            options.append(("", DROP if c not in LEET else DROP + SUBSTITUTE))
        return options or [("", DROP)]

    def lattice(self, token: str) -> Iterator[list[tuple[str, float]]]:
        """The alternatives of each run of equal characters."""
        for m in re.finditer(r"(.)\1*", token, re.S):
            yield self.options(m[1], len(m[0]))

    def spaced_lattice(self, run: str, border: float) -> Iterator[list[tuple[str, float]]]:
        """The alternatives of a spaced-out run: between two signs there may be a
        border, for ``border`` nats in the narrowest gaps and for nothing in wider ones."""
        signs = [(len(gap) + (" " in gap), sign) for gap, sign in SIGNS.findall(run)]  # width of the gap before it
        narrow = min((width for width, _ in signs[1:]), default=0)
        k = 0
        while k < len(signs):
            width, sign = signs[k]
            if k:
                wide = width > narrow
                yield [("", JOIN if wide else 0.0), (" ", 0.0 if wide else border)]
            n = k + 1
            while n < len(signs) and signs[n][1] == sign and signs[n][0] <= narrow:
                n += 1
            options = self.options(sign, n - k)
            if n > k + 1:
                options = options + [(f"{x} {x}", cost + border) for x, cost in self.options(sign, 1) if x]
            yield options
            k = n

    def restore(self, lattice: Iterable[list[tuple[str, float]]], known: bool = False) -> str:
        """Viterbi over the lattice; a state is the last two letters and, with ``known``, the
        beginning of a known word since the last border. Paths are chains that share
        their beginnings; what all of them agree on is written out."""
        logp, code, done = self.logp, LETTER_CODE, []
        beam = {(BORDER, BORDER, "" if known else None): (0.0, None)}
        for options in lattice:
            new: dict = {}
            for (a, b, word), (cost, path) in beam.items():
                for letters, extra in options:
                    x, y, w, c = a, b, word, cost + extra
                    for letter in letters:
                        k = code.get(letter, OTHER)
                        c -= logp[x][y][k]
                        x, y = y, k
                    if known:
                        for letter in letters:
                            if letter == " ":
                                c -= KNOWN if w in self.known else 0.0
                                w = ""
                            elif w is not None:
                                w = w + letter if w + letter in self.begun else None
                    old = new.get((x, y, w))
                    if old is None or c < old[0]:
                        new[x, y, w] = (c, (path, letters) if letters else path)
            beam = new
            if len(beam) == 1:
                (state, (cost, path)), = beam.items()
                done += _written(path)
                beam = {state: (cost, None)}
        best = min(((c - logp[a][b][BORDER] - (KNOWN if w in self.known else 0.0), path) for (a, b, w), (c, path) in beam.items()),
                   key=lambda x: x[0])[1]
        return "".join(done + _written(best))

    def obfuscated(self, core: str) -> bool:
        return not PLAIN.fullmatch(core) or RUN.search(core) is not None

    def words(self, token: str, opened: bool = False) -> list[str]:
        """Plain and restored forms of one lower-cased token; an edge "(" may be a
        letter if it is ``opened`` for good."""
        # sentence punctuation and repeated signs around a word are no part of it, but may stand for letters
        raw = token.strip(QUOTES_BUT_OPEN if opened else QUOTES)
        if PLAIN.fullmatch(raw) and not RUN.search(raw):
            return [raw]
        raw = raw.rstrip("!") if raw.endswith("!!") else raw
        token = _undecorated(token.strip(QUOTES)).strip(QUOTES)
        core = EDGE.sub("", token)
        plain = [core] if core and LETTER.search(core) else []
        if not plain and (core or not raw) and sum(c in LEET and not c.isdigit() for c in raw) < 2:
            return []  # nothing, or a number and its sign
        # "$tupid", "idi0t!", "a$$": an edge may be a letter
        forms = plain + [self.restore(self.lattice(shape)) for shape in dict.fromkeys((core, token, raw))
                         if self.obfuscated(shape) and (plain or shape == raw)]
        if plain and self.obfuscated(token):
            forms += PLAIN.findall(core) if not PLAIN.fullmatch(core) else []
        return list(dict.fromkeys(f for f in forms if f))

    def spaced_words(self, run: str) -> list[str]:
        """Words of a lower-cased spaced-out run, in the likeliest divisions."""
        found = [w for border in BORDERS for w in self.restore(self.spaced_lattice(run, border), known=True).split()]
        return list(dict.fromkeys(found))


def features(word: str) -> list[str]:
    return ["=" + word, *(word[:k] for k in BEGINNINGS if len(word) > k)]


class Extractor:
    """Features of whole texts, memoised by token (bounded per worker)."""

    def __init__(self, model: np.ndarray, keep: dict[str, int] | None = None):
        self.channel = Channel(model, (f[1:] for f in keep or () if f[0] == "="))
        self.keep, self.memo = keep, {}

    def of_token(self, token: str, opened: bool = False) -> tuple:
        key = (token, opened) if opened else token
        known = self.memo.get(key)
        if known is None:
            found = [f for w in self.channel.words(token, opened) for f in features(w)]
            known = tuple(found) if self.keep is None else tuple(self.keep[f] for f in found if f in self.keep)
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[key] = known
        return known

    def of_text(self, text: str | None) -> set:
        text = (text or "").lower()
        out: set = set()
        opened = text.count("(") > text.count(")")  # else every "(" is a bracket
        memo, tokens = self.memo, set(text.split())
        for token in tokens:
            known = memo.get(token)
            if known is None:
                known = self.of_token(token)
            if known:
                out.update(known)
        for token in tokens if opened else ():
            if "(" in token:
                out.update(self.of_token(token, opened))
        for run in spaced_runs(text):
            joined = re.sub(r"[ ._\-]", "", run)
            for shape in (joined, joined[1:], joined[:-1]):  # "a" and "i" may stand beside
                out.update(self.of_token(shape))
            for word in self.channel.spaced_words(run):
                out.update(self.of_token(word))
        return out


# ------------------------------------------------------------------ classifier

class Classifier:
    def __init__(self, model: np.ndarray, names: list[str], weights: np.ndarray, bias: float):
        self.model, self.keep, self.weights, self.bias = model, {n: i for i, n in enumerate(names)}, weights, bias

    def probability(self, present: set) -> float:
        z = self.bias + sum(self.weights[i] for i in present)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _regression(rows: list[tuple[list[int], int]], n: int, steps_: int = 300, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on binary features by accelerated gradient steps."""
    y = np.array([t for _, t in rows], float)
    doc = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    col = np.array([i for f, _ in rows for i in f], np.int64)
    balance = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w, b = np.zeros(n), 0.0
    vw, vb = np.zeros(n), 0.0
    for _ in range(steps_):
        z = b + np.bincount(doc, w[col], minlength=len(rows))
        g = balance * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        vw = 0.9 * vw - 4.0 * (np.bincount(col, g[doc], minlength=n) + l2 * w / max(n, 1))
        vb = 0.9 * vb - 4.0 * g.sum()
        w, b = w + vw, b + vb
    return w, b


def fit(docs: DataFrame, labels: DataFrame, mod: int = 5, sample: int = SAMPLE) -> Classifier:
    """Learn from labelled rows whose crc32(id) mod ``mod`` is not 0."""
    docs = documents(docs)
    model = char_model(docs)
    train = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .filter(crc_mod(F.col("doc_id"), mod) != 0))
    n = {r.toxic: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    h = F.xxhash64("doc_id")
    # the smallest hashes: twice the share that is wanted, then the order in it
    few = {t: train.filter((F.col("toxic") == t) & (h <= hash_bound(2 * sample / max(n.get(t, 0), 1)))) for t in (0, 1)}
    picked = few[0].orderBy(h, "doc_id").limit(sample).union(few[1].orderBy(h, "doc_id").limit(sample))  # 2 * sample ids at most
    # one text an id, however often the id repeats
    picked = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")
    picked = staged(picked, "toxicity-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(model)
        for batch in steps(batches, step_bytes=1 << 20):
            found = [sorted(extract.of_text(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.string()))],
                                             ["doc_id", "toxic", "found"])
        del extract
        release()

    rows = picked.mapInArrow(run, "doc_id long, toxic int, found array<string>")
    n = {r.toxic: r["n"] for r in picked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean_n, toxic_n = n.get(0, 0), n.get(1, 0)
    if not clean_n or not toxic_n:
        return Classifier(model, [], np.zeros(0), -40.0)
    counts = rows.select("toxic", F.explode("found").alias("f")).groupBy("f").agg(
        F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    share = toxic_n / (toxic_n + clean_n)
    # G2 of the feature's label split against the sample's
    part = lambda k, p: F.when(k > 0, k * F.log(k / (F.col("n") * p))).otherwise(0.0)
    evidence = 2 * (part(F.col("t"), share) + part(F.col("n") - F.col("t"), 1 - share))
    strong = counts.filter((F.col("t") >= MIN_DOCS) & (F.col("t") >= F.col("n") * MIN_PRECISION)).withColumn("g", evidence).filter(
        F.col("g") >= MIN_EVIDENCE).orderBy(F.desc("g"), "f")
    names = [r.f for r in strong.select("f").collect()]
    keep = {f: i for i, f in enumerate(names)}

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(model, keep)
        for batch in steps(batches, step_bytes=1 << 20):
            found = [sorted(extract.of_text(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column("toxic")], ["found", "toxic"])
        del extract
        release()

    seen = [(list(r.found), r.toxic) for r in picked.mapInArrow(project, "found array<int>, toxic int").collect()]
    return Classifier(model, names, *_regression(seen, len(names)))


def score(docs: DataFrame, classifier: Classifier, mod: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(classifier.model, classifier.keep)
        for batch in steps(batches):
            ids = batch.column("doc_id").to_pylist()
            p = [classifier.probability(extract.of_text(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([crc_mod_py(i, mod) == 0 for i in ids], pa.bool_()), pa.array(p, pa.float64()),
                 pa.array([int(x >= 0.5) for x in p], pa.int32())], ["doc_id", "held_out", "score", "predicted"])
        del extract
        release()

    return documents(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def keep_clean(docs: DataFrame, classifier: Classifier, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are predicted toxic; one narrow pass, all columns pass through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(classifier.model, classifier.keep)
        for batch in steps(batches, text_col):
            keep = [classifier.probability(extract.of_text(t)) < 0.5 for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))
        del extract
        release()

    return docs.mapInArrow(run, docs.schema)
