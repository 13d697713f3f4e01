"""Plain Python versions of the contracts, for comparison on small data."""

import hashlib
import re

ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def low(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def index_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def contaminated(docs, items, window=10):
    phrases = {}
    for item, text in items:
        w = index_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    sizes = {len(p) for p in phrases}
    out = []
    for doc, text in docs:
        w, hit, found = index_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (got := phrases.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def fingerprint(text, k=3):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(docs, bits=3):
    """{doc_id: (fingerprint, smallest id reachable)}"""
    import numpy as np

    fp = {i: fingerprint(t) for i, t in docs}
    ids = sorted(fp)
    values = np.array([fp[i] for i in ids], np.uint64)
    group = {i: i for i in ids}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, i in enumerate(ids):
        for b in np.flatnonzero(np.bitwise_count(values ^ values[a]) <= bits).tolist():
            x, y = root(i), root(ids[b])
            group[max(x, y)] = min(x, y)
    return {i: (f"{fp[i]:016x}", root(i)) for i in ids}


def stripped(docs, span=200):
    """(id, bytes, removed, spans, sha of the rest) with every byte of a repeated span removed."""
    from collections import Counter

    data = [(i, (t or "").encode()) for i, t in docs]
    count = Counter(d[k:k + span] for _, d in data for k in range(len(d) - span + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - span + 1):
            if count[d[k:k + span]] > 1:
                gone[k:k + span] = b"\x01" * span
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(d)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
