"""Plain single-machine versions of the operators' contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def text_counts(text):
    t, w = text or "", words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def simhash(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def components(fps, bits=3):
    """Class number of each fingerprint in a list: links at ``bits`` or fewer differing bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    a = np.array(fps, dtype=np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= bits):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def _luhn(d):
    total = 0
    for i, c in enumerate(d[::-1]):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(s):
    return re.sub("[^0-9]", "", s)


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) < 256 for x in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(_digits(s)) <= 19 and _luhn(_digits(s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(_digits(s)) <= 15),
]


def pii(text):
    out = []
    for k, (name, pattern, ok) in enumerate(PII):
        out += [(m.start(), k, name, m.end()) for m in re.finditer(pattern, text or "") if ok(m[0])]
    return ",".join(f"{n}:{s}:{e}" for s, _, n, e in sorted(out))


def targets(sizes, cap=3, weights=(1, 2, 3)):
    """source -> target, by sharing the excess again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, live, out = float(sum(sizes.values())), set(order), {}
    while live:
        total = sum(w[s] for s in live)
        over = [s for s in live if left * w[s] / total > cap * sizes[s]]
        if not over:
            return out | {s: left * w[s] / total for s in live}
        for s in over:
            out[s] = float(cap * sizes[s])
            live.discard(s)
        left = float(sum(sizes.values())) - sum(out.values())
    return out


def pieces(docs, length=2048):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for doc_id, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for p, a in enumerate(range(0, len(ids), length)):
            x = ids[a:a + length]
            out.append((doc_id, p, a, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    return out


def edited_sha(text, following):
    t, m = text or "", len(text or "") // 3
    return hashlib.sha256((t[:len(t) - m] + (following or "")[:m]).encode()).hexdigest()
