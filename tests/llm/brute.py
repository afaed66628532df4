"""Plain Python versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repeated_bytes(docs, size=200):
    """(key, n_bytes, n_removed, n_spans, sha) per (key, text)."""
    texts = [(k, (t or "").encode()) for k, t in docs]
    seen = Counter(t[i:i + size] for _, t in texts for i in range(len(t) - size + 1))
    out = []
    for k, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        spans = sum(1 for i in range(len(t)) if gone[i] and (not i or not gone[i - 1]))
        out.append((k, len(t), sum(gone), spans, sha(bytes(b for b, g in zip(t, gone) if not g))))
    return out


def later_windows(docs, n=13):
    """(key, n_words, n_removed, sha) per (key, text)."""
    first = {}
    split = [(k, words(t)) for k, t in docs]
    for k, w in split:
        if k is not None:
            for i in range(len(w) - n + 1):
                x = tuple(w[i:i + n])
                first[x] = min(first.get(x, k), k)
    out = []
    for k, w in split:
        gone = set()
        for i in range(len(w) - n + 1):
            if k is not None and first[tuple(w[i:i + n])] < k:
                gone.update(range(i, i + n))
        out.append((k, len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def simhash(text):
    w = words((text or ""))
    w = [x.lower() for x in w]
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash_components(docs, distance=3):
    """{row number: (fingerprint, component)} for (key, text)."""
    fps = [simhash(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(docs):
        r = find(i)
        if k is not None:
            least[r] = min(least.get(r, k), k)
    return [(k, f"{fps[i]:016x}", least.get(find(i))) for i, (k, _) in enumerate(docs)]


def quality(text):
    w = words(text)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {i + j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def license_words(text):
    raw = (text or "").encode()
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw).decode()
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def license_base(text, phrases):
    w = license_words(text)
    places = [(i, name) for name, p in phrases.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def contained(docs, items, n=5, threshold=0.8):
    def shingles(text, width=n):
        w = license_words(text)
        return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}

    out = []
    for item, text in items:
        width = min(n, len(license_words(text)))
        q = shingles(text, width) if width else set()
        for k, t in docs:
            shared = len(q & shingles(t, width)) if q else 0
            if q and shared >= threshold * len(q) - 1e-9:
                out.append((k, item, shared, len(q)))
    return sorted(out, key=str)


def by_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return bytes(b + 32 if 65 <= b <= 90 else b for b in host.encode()).decode(), path


def grouped(rows, n=1):
    out = defaultdict(list)
    for r in rows:
        out[r[:n]].append(r)
    return out
