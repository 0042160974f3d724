"""Plain Python versions of the contracts, for comparison on small data."""

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(doc_id, mod):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found)


def spans(found):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in found)


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items, window=10):
    """doc -> (n_words, n_hit, sorted item ids) by looking every window up."""
    wins = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        size = min(window, len(w))
        for k in range(len(w) - size + 1) if w else ():
            wins.setdefault(tuple(w[k:k + size]), set()).add(str(item))
    sizes = {len(w) for w in wins}
    out = []
    for doc_id, text in docs:
        w, hit, found = ALNUM.findall(lower(text)), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                of = wins.get(tuple(w[k:k + size]))
                if of:
                    hit.update(range(k, k + size))
                    found |= of
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


def lm_base(docs, mod=10):
    """doc -> (held_out, n_tokens, n_known, train_tokens, base_score)."""
    from collections import Counter
    from math import log10
    tokens = [(i, [*WORD.findall(lower(t)), None]) for i, t in docs]
    count = Counter(w for i, ws in tokens if crc(i, mod) for w in ws)
    n, v = count.total(), len(count)
    return [(i, crc(i, mod) == 0, len(ws), sum(w in count for w in ws), n,
             sum(log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in tokens]
