"""Plain Python versions of what the operators return, for small inputs."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def luhn(d):
    x = [int(c) for c in d][::-1]
    return sum(x[0::2] + [sum(divmod(2 * y, 10)) for y in x[1::2]]) % 10 == 0


def pii(text):
    out = []
    pats = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    for k, p in enumerate(pats):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split(".")) \
                    or k == 2 and 14 <= len(d) <= 19 and luhn(d) or k == 3 and 10 <= len(d) <= 15:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def secrets(text):
    out = []
    pats = [r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            r"AKIA[A-Z0-9]+", r"[0-9a-f]+"]
    for k, p in enumerate(pats):
        for m in re.finditer(p, text or ""):
            if k == 0 and len(m[1]) >= 12 or k == 1 and len(m[0]) >= 18 or k == 2 and len(m[0]) >= 16:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def shown(spans, kinds):
    return [f"{kinds[k]}:{s}:{e}" for s, k, e in spans]


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def measures(text):
    t = text or ""
    w = WORD.findall(t)
    n = len(w)
    c = collections.Counter(tuple(w[i:i + 5]) for i in range(n - 4))
    cov = set()
    for i in range(n - 4):
        if c[tuple(w[i:i + 5])] > 1:
            cov.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (n, sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(lines) - len(set(lines)), len(cov),
            n < 10 or 100 * len(cov) > 20 * n)


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def components(texts):
    """[component of each row], a component named by its first row's index."""
    sets = [shingles(t) for t in texts]
    par = list(range(len(texts)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                par[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def trimmed(texts, length=200):
    """[(n_bytes, n_removed, n_spans, kept hash)] of each row."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[s:s + length] for b in raw for s in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, gone) if not m)
        spans = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
