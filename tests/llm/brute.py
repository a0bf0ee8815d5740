"""Plain definitions that the operators must agree with."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def suffix(rows, width=100):
    seen, out = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - width + 1):
            w = b[p:p + width]
            if w in seen:
                cover[p:p + width] = b"\1" * width
            seen.add(w)
        runs = sum(1 for k in range(len(b)) if cover[k] and (k == 0 or not cover[k - 1]))
        out[i] = (len(b), sum(cover), runs, sha(bytes(x for x, c in zip(b, cover) if not c)))
    return out


def substring(rows, width=35):
    words = {i: WORD.findall(t or "") for i, t in rows}
    count = Counter(tuple(w[p:p + width]) for w in words.values() for p in range(len(w) - width + 1))
    out = {}
    for i, w in words.items():
        cover = [False] * len(w)
        for p in range(len(w) - width + 1):
            if count[tuple(w[p:p + width])] > 1:
                cover[p:p + width] = [True] * width
        out[i] = (len(w), sum(cover), sha(" ".join(x for x, c in zip(w, cover) if not c).encode()))
    return out


def shingles(text, size=4):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return frozenset(tuple(words[a:a + size]) for a in range(max(1, len(words) - size + 1))) if words else frozenset()


def classes(rows, percent=85, size=4):
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def contaminated(docs, items, percent=80):
    out = {}
    listed = []
    for i, t in items:
        w = WORD.findall((t or "").lower())
        if w and i is not None:
            k = min(5, len(w))
            listed.append((i, len(w), k, Counter(tuple(w[a:a + k]) for a in range(len(w) - k + 1))))
    for d, t in docs:
        w = WORD.findall((t or "").lower())
        for i, n, k, c in listed:
            size = min(n, len(w))
            m = size - k + 1
            if m < 1:
                continue
            found = [tuple(w[a:a + k]) for a in range(len(w) - k + 1)]
            both = m + n - k + 1
            for s in range(len(w) - size + 1):
                x = sum((Counter(found[s:s + m]) & c).values())
                if x * (100 + percent) >= percent * both and x / (both - x) > out.get((d, i), (0, 0))[0]:
                    out[d, i] = (x / (both - x), s)
    return out


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    c = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))


def languages_phrases(codes, learned):
    """Phrases of a greedy parse into substrings of `learned`."""
    i = n = 0
    while i < len(codes):
        j = i + 1
        while j <= len(codes) and codes[i:j] in learned:
            j += 1
        i, n = max(j - 1, i + 1), n + 1
    return n


def url(text):
    if text is None or "://" not in text:
        return "", ""
    rest = text.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


