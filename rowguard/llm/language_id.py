"""Operator 9: hierarchical language identification.

Texts become relative frequencies of hashed byte n-grams (one to three) of their
letters. A family is predicted first (one linear machine a family, the largest
margin wins), then one-versus-one linear support vector machines vote among the
languages of that family; a family of one language needs no vote.

The machines are fitted on a bounded sample (``SAMPLE`` training texts a
language, ``SAMPLE_ALL`` in all but 20 a language, ``MAX_LANGUAGES`` languages,
chosen by hash, one text an id) and are a few hundred kilobytes;
every whole text is then predicted in one narrow pass without a shuffle.

Defined results: ``und`` with score 0 for a null text or one without a letter,
and for every text when nothing can be learned; training rows without a language
or without a letter are skipped; a null id counts as the empty text in crc32
(held out); repeated rows repeat their result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowguard.llm.common import crc_mod, crc_mod_py, documents, hash_bound, steps

DIMENSIONS = 4096
SAMPLE, SAMPLE_ALL = 1000, 6000
#: most languages that are learned, those with most training texts
MAX_LANGUAGES = 64
#: fixed values: language families by code; any other language is a family of its own
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es it pt ca ro gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "indic": "hi bn ur pa gu mr ne si",
    "turkic": "tr az kk ky uz tt",
    "uralic": "fi et hu",
    "semitic": "ar he am mt",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
UNKNOWN = "und"
#: letters, and number signs such as "½" and "Ⅷ", which are none
LETTERLIKE = re.compile(r"[^\W\d_]")
#: ASCII letters lower-cased, other ASCII a space, everything else kept
_MAP = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def has_letter(text: str | None) -> bool:
    return any(m.group().isalpha() for m in LETTERLIKE.finditer(text or ""))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram codes of all texts in a row, and where each text begins.

    A text starts and ends with a border; there are three codes per byte.
    """
    parts = [b" ".join([b"", *t.lower().encode().translate(_MAP).split(), b""]) for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b"".join(parts) + b"  ", np.uint8).astype(np.uint32)
    a, b, c = data[:-2], data[1:-1], data[2:]
    one = a * np.uint32(2654435761)
    two = (a * np.uint32(257) + b + np.uint32(7)) * np.uint32(2654435761)
    three = ((a * np.uint32(257) + b) * np.uint32(257) + c + np.uint32(13)) * np.uint32(2654435761)
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    # the last two bytes of a text would look into the next one: borders there
    codes = np.stack([one >> shift, two >> shift, three >> shift], axis=1)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ends = starts[1:]
    codes[ends - 1, 1:] = 0
    codes[ends - 2, 2] = 0
    return codes, starts


def vector(text: str) -> np.ndarray:
    codes, _ = grams([text])
    return np.sqrt(np.bincount(codes.reshape(-1), minlength=DIMENSIONS) / codes.size).astype(np.float32)


def _machine(x: np.ndarray, y: np.ndarray, rounds: int = 150, l2: float = 1e-4) -> np.ndarray:
    """Linear support vector machine (squared hinge) by accelerated gradient steps; bias last."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, v = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ w))
        v = 0.9 * v - 0.5 * (l2 * w - 2 * x.T @ (share * y * slack))
        w = w + v
    return w


class Model:
    def __init__(self, languages: list[str], x: np.ndarray, y: np.ndarray):
        self.languages = languages
        family = [FAMILY_OF.get(code, f"only {code}") for code in languages]
        self.families = sorted(set(family))
        self.members = {f: [i for i, g in enumerate(family) if g == f] for f in self.families}
        fam = np.array([self.families.index(family[i]) for i in y], np.int64)
        columns = []
        if len(self.families) > 1:
            columns += [_machine(x, np.where(fam == f, 1, -1).astype(np.float32)) for f in range(len(self.families))]
        self.duels = []
        for members in self.members.values():
            for i, j in combinations(members, 2):
                own = (y == i) | (y == j)
                columns.append(_machine(x[own], np.where(y[own] == i, 1, -1).astype(np.float32)))
                self.duels.append((i, j))
        self.n_family = len(columns) - len(self.duels)
        self.weights = np.stack(columns, axis=1) if columns else np.zeros((DIMENSIONS + 1, 0), np.float32)

    def predict(self, margins: np.ndarray) -> tuple[str, float]:
        sigmoid = lambda m: float(1 / (1 + np.exp(-np.clip(2 * m, -40, 40))))
        score, family = 1.0, self.families[0]
        if self.n_family:
            best = int(np.argmax(margins[:self.n_family]))
            family, score = self.families[best], sigmoid(margins[best])
        members = self.members[family]
        if len(members) == 1:
            return self.languages[members[0]], score
        won = dict.fromkeys(members, 0.0)
        for (i, j), m in zip(self.duels, margins[self.n_family:]):
            if i in won and j in won:
                p = sigmoid(m)
                won[i] += (m >= 0) + p / 1e3  # votes first, then margins
                won[j] += (m < 0) + (1 - p) / 1e3
        top = max(members, key=lambda i: (won[i], -i))
        own = [sigmoid(m if i == top else -m) for (i, j), m in zip(self.duels, margins[self.n_family:]) if top in (i, j)]
        return self.languages[top], score * float(np.mean(own))


def fit(docs: DataFrame, mod: int = 5, sample: int = SAMPLE, sample_all: int = SAMPLE_ALL) -> Model | None:
    """Learn from rows whose crc32(id) mod ``mod`` is not 0 and whose lang is not null."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    usable = rows.filter("doc_id IS NOT NULL AND lang IS NOT NULL").filter(crc_mod(F.col("doc_id"), mod) != 0)
    # the languages with most training texts; a code that fewer use than all of these is none to learn
    usable = usable.select("doc_id", "lang").distinct()  # an id counts once, however often it repeats
    known = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    if not known:
        return None
    each = max(20, min(sample, sample_all // len(known)))
    # the smallest hashes of a language: twice the share that is wanted, then the rank in it
    h = F.xxhash64("doc_id")
    share = F.create_map(*[F.lit(x) for r in known for x in (r.lang, hash_bound(2 * each / r.n))])
    ids = usable.filter(h <= share[F.col("lang")])
    order = Window.partitionBy("lang").orderBy(h, "doc_id")
    ids = ids.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= each).select("doc_id", "lang")
    # one text an id, however often the id repeats; at most each * languages ids
    picked = rows.join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("doc_id", "text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, step_bytes=1 << 20):
            out = [(code, vector(t).tobytes()) for t, code in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist())
                   if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.string()), pa.array([v for _, v in out], pa.binary())],
                                             ["lang", "x"])

    got = sorted((r.lang, bytes(r.x)) for r in picked.mapInArrow(run, "lang string, x binary").collect())
    if not got:
        return None
    languages = sorted({lang for lang, _ in got})
    x = np.frombuffer(b"".join(v for _, v in got), np.float32).reshape(len(got), DIMENSIONS)
    return Model(languages, x, np.array([languages.index(lang) for lang, _ in got]))


def identify(docs: DataFrame, model: Model | None, mod: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, from its text alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, step_bytes=1 << 20):
            ids = batch.column("doc_id").to_pylist()
            result = [(UNKNOWN, 0.0)] * len(ids)
            for i, text in enumerate(batch.column("text").to_pylist()):
                if model is not None and has_letter(text):
                    margins = vector(text) @ model.weights[:-1] + model.weights[-1]
                    result[i] = model.predict(margins)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([crc_mod_py(i, mod) == 0 for i in ids], pa.bool_()),
                 pa.array([p for p, _ in result], pa.string()), pa.array([s for _, s in result], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    return documents(docs, id_col, text_col).mapInArrow(run, SCHEMA)
