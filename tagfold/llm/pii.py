"""Personal data by plain rules and a semi-Markov conditional random field.

Four rules (email, ip, card, phone) give the base spans. The method adds
spans: a text's digit groups and spelled-out addresses are atoms, atoms close
to each other form a chain, and a chain is cut into segments of one to
``MAX_ATOMS`` atoms, each labelled with a kind or as nothing. Features look at
a whole segment (digits, group lengths, separators, checksum, neighbours), and
dynamic programming over the chain picks boundaries and kinds together. The
weights are fitted by maximum likelihood on the base spans of a bounded sample
of documents (``TRAIN_DOCS``, ``TRAIN_CHARS``), from their chains of at most
``TRAIN_ATOMS`` atoms (found spans have no such bound); the sign that the phone rule insists on is
hidden from half of the training segments, so that numbers are recognised by
their shape as well.

Edge cases: a null text is empty; a null id is kept; repeated rows each get
their own, equal result; ties in start are ordered by kind; a very long text is
searched whole, in time that grows with the square of the number of its
spelled-out addresses and in proportion to all else; without a training
document nothing is added; an empty table gives an empty result; extra columns
are left aside.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
# bound of the training sample: documents with a digit or "@", in hash order
TRAIN_DOCS = 2000
# and of at most so many characters, so that the sample fits the driver
TRAIN_CHARS = 20_000
# chains that the weights are fitted on have at most so many atoms
TRAIN_ATOMS = 64
MAX_ATOMS = 8
EPOCHS = 6
# an added span needs this posterior odds over leaving its atoms unmarked
MIN_MARGIN = 2.0
# score of a feature that no training segment had
UNSEEN = -2.0

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a digit run is entered at its first digit only, which finds the same matches
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
GAP = re.compile(r"[\x20().\-/+]{1,3}")
AT = re.compile(r"\x20?[(\[]at[)\]]\x20?", re.I)
SPELLED = re.compile(r"[A-Za-z0-9-]{1,64}(?:(?:\x20?[(\[]dot[)\]]\x20?|\.)[A-Za-z0-9-]{1,64}){1,8}", re.I)
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def emails(text: str):
    at, low, seen = text.find("@"), 0, 0
    while at >= 0:
        # the local part reaches left to the last match, the last "@" or a foreign character
        left = text[max(low, seen):at]
        start = max(low, seen) + len(left.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            low = m.end()
        seen = at + 1
        at = text.find("@", max(low, seen))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order; a failing match is dropped and not retried."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in emails(text)]
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(map(_octet, m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if 14 <= m.end() - m.start():
                d = NOT_DIGIT.sub("", m[0])
                if 14 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


# ------------------------------------------------------- chains and features

def chains(text: str) -> list[list[tuple[int, int, int]]]:
    """Chains of atoms (start, end, 0 digits / 1 spelled-out address)."""
    spelled: list[tuple[int, int, int]] = []  # in order and apart: a later one replaces what it overlaps
    starts: list[int] = []  # what any of them covered, merged
    ends: list[int] = []
    for m in AT.finditer(text):
        window = text[max(0, m.start() - 64):m.start()]
        start = m.start() - (len(window) - len(window.rstrip(LOCAL)))
        d = SPELLED.match(text, m.end())
        if start < m.start() and d:
            while spelled and spelled[-1][1] > start:
                spelled.pop()
            spelled.append((start, d.end(), 1))
            first, last = start, d.end()
            while ends and ends[-1] > first:
                first, last = min(first, starts.pop()), max(last, ends.pop())
            starts.append(first)
            ends.append(last)
    atoms = spelled
    for m in DIGITS.finditer(text):
        k = bisect.bisect_left(starts, m.end()) - 1
        if k < 0 or ends[k] <= m.start():
            atoms.append((m.start(), m.end(), 0))
    atoms.sort()
    out: list[list[tuple[int, int, int]]] = []
    for a in atoms:
        if out and GAP.fullmatch(text, out[-1][-1][1], a[0]):
            out[-1].append(a)
        else:
            out.append([a])
    return out


def allowed(text: str, chain, i: int, j: int) -> list[int]:
    """Kinds that atoms i to j (inclusive) could be at all."""
    seg = chain[i:j + 1]
    if any(a[2] for a in seg):
        return [0] if len(seg) == 1 else []
    n = sum(e - s for s, e, _ in seg)
    kinds = []
    if len(seg) == 4 and n <= 12 and all(text[a[1]:b[0]].strip() == "." for a, b in zip(seg, seg[1:])) \
            and all(e - s < 4 and int(text[s:e]) <= 255 for s, e, _ in seg):
        kinds.append(1)
    if 13 <= n <= 19 and len(seg) <= 6:
        kinds.append(2)
    if 7 <= n <= 15 and len(seg) <= 6:
        kinds.append(3)
    return kinds


def features(text: str, chain, i: int, j: int, kind: int, hide_sign: bool = False) -> list[str]:
    """Features of the whole segment, with its kind."""
    seg = chain[i:j + 1]
    s, e = seg[0][0], seg[-1][1]
    digits = "".join(text[a:b] for a, b, c in seg if not c)
    seps = "".join(sorted({ch for a, b in zip(seg, seg[1:]) for ch in text[a[1]:b[0]]}))
    before, after = text[max(0, s - 12):s], text[e:e + 1]
    sign = before.rstrip("( ").endswith("+") and not hide_sign
    word = re.search(r"([A-Za-z]+)[\s:.+(]*$", before)
    f = ["bias", f"digits={len(digits)}", "groups=" + "-".join(str(min(b - a, 5)) for a, b, _ in seg[:5]),
         f"seps={seps}", f"sign={sign}", f"edge={after.isalnum()}{before[-1:].isalnum()}",
         f"spelled={seg[0][2]}"]
    if kind == 2:
        f.append(f"luhn={luhn(digits)}")
    if word and word[1].lower() in ("tel", "phone", "call", "fax", "mobile", "card", "visa", "ip", "mail"):
        f.append(f"cue={word[1].lower()}")
    return [f"{kind}|{x}" for x in f]


def lattice(text: str, chain, hide_sign: bool = False):
    """[(i, j, kind, features)] of all candidate segments, with unmarked atoms."""
    out = [(i, i, NONE, ["none"]) for i in range(len(chain))]
    for i in range(len(chain)):
        for j in range(i, min(len(chain), i + MAX_ATOMS)):
            out += [(i, j, k, features(text, chain, i, j, k, hide_sign)) for k in allowed(text, chain, i, j)]
    return out


def _scores(lat, w):
    return [sum(w.get(f, 0.0) for f in seg[3]) for seg in lat]


def _forward(n, lat, score):
    """log-sums of all cuttings of the first t atoms, t = 0 to n."""
    ends: list[list] = [[] for _ in range(n + 1)]
    for (i, j, _, _), s in zip(lat, score):
        ends[j + 1].append((i, s))
    a = [0.0] + [-math.inf] * n
    for t in range(1, n + 1):
        v = [a[i] + s for i, s in ends[t]]
        m = max(v)
        a[t] = m + math.log(sum(math.exp(x - m) for x in v))
    return a


def _backward(n, lat, score):
    starts: list[list] = [[] for _ in range(n + 1)]
    for (i, j, _, _), s in zip(lat, score):
        starts[i].append((j + 1, s))
    b = [-math.inf] * n + [0.0]
    for t in range(n - 1, -1, -1):
        v = [b[e] + s for e, s in starts[t]]
        m = max(v)
        b[t] = m + math.log(sum(math.exp(x - m) for x in v))
    return b


def train(texts: list[str], epochs: int = EPOCHS, seed: int = 7) -> dict[str, float]:
    """Weights by stochastic gradient ascent of the conditional likelihood."""
    rng, w, data = np.random.default_rng(seed), {}, []
    for text in texts:
        gold = {}
        for s, k, e in base_spans(text):
            gold.setdefault(e, []).append((s, k))
        for chain in chains(text):
            if len(chain) > TRAIN_ATOMS or not any(allowed(text, chain, i, j) for i in range(len(chain))
                                          for j in range(i, min(len(chain), i + MAX_ATOMS))):
                continue
            hide = bool(rng.random() < 0.5)
            lat = lattice(text, chain, hide)
            marked = set()
            for x, (i, j, k, _) in enumerate(lat):
                if k != NONE and any(g == k and chain[i][0] - 2 <= s <= chain[i][0] and (i == 0 or chain[i - 1][1] <= s)
                                     for s, g in gold.get(chain[j][1], [])):
                    marked.add(x)
            taken = [False] * len(chain)
            best = set()
            for x in sorted(marked, key=lambda x: lat[x][0] - lat[x][1]):
                i, j = lat[x][:2]
                if not any(taken[i:j + 1]):
                    best.add(x)
                    taken[i:j + 1] = [True] * (j + 1 - i)
            best |= {x for x, (i, _, k, _) in enumerate(lat) if k == NONE and not taken[i]}
            data.append((len(chain), lat, best))
    for epoch in range(epochs):
        rate = 0.5 / (1 + epoch)
        for d in rng.permutation(len(data)):
            n, lat, best = data[d]
            score = _scores(lat, w)
            a, b = _forward(n, lat, score), _backward(n, lat, score)
            for x, ((i, j, _, feats), s) in enumerate(zip(lat, score)):
                g = (x in best) - math.exp(a[i] + s + b[j + 1] - a[n])
                for f in feats:
                    w[f] = w.get(f, 0.0) + rate * (g - 1e-4 * w.get(f, 0.0))
    return w


def decode(text: str, w: dict[str, float]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the best cutting of every chain."""
    out = []
    for chain in chains(text):
        n = len(chain)
        ends: list[list] = [[(t - 1, NONE, w.get("none", 0.0))] if t else [] for t in range(n + 1)]
        some = False
        for i in range(n):
            for j in range(i, min(n, i + MAX_ATOMS)):
                for k in allowed(text, chain, i, j):
                    some = True
                    s = sum(w.get(f, UNSEEN) for f in features(text, chain, i, j, k))
                    ends[j + 1].append((i, k, s - MIN_MARGIN))
        if not some:
            continue
        best, back = [0.0] + [-math.inf] * n, [None] * (n + 1)
        for t in range(1, n + 1):
            for i, k, s in ends[t]:
                if best[i] + s > best[t]:
                    best[t], back[t] = best[i] + s, (i, k)
        t = n
        while t:
            i, k = back[t]
            if k != NONE:
                s = chain[i][0]
                while k == 3 and s and text[s - 1] in "+(":
                    s -= 1
                out.append((s, k, chain[t - 1][1]))
            t = i
    return out


def find(text: str, w: dict[str, float]):
    """(base spans, all spans): the rules' and those with what the field adds."""
    base = base_spans(text)
    if not DIGITS.search(text) and not AT.search(text):
        return base, base
    free = []
    if w:
        at = 0
        by_start = sorted(base)
        reach = []  # running maximum of the ends, to test overlaps by start
        top = 0
        for s, _, e in by_start:
            top = max(top, e)
            reach.append(top)
        starts = [s for s, _, _ in by_start]
        for s, k, e in sorted(decode(text, w)):
            at = int(np.searchsorted(starts, e)) if starts else 0
            if not at or reach[at - 1] <= s:
                free.append((s, k, e))
    return base, sorted(base + free)


def shown(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# ------------------------------------------------------------------- Spark

def fitted(docs: DataFrame, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> dict[str, float]:
    """Weights fitted on at most ``train_docs`` texts of ``docs``, the first in
    the order of their hash; copies count once."""
    some = (docs.select("text").filter(F.col("text").rlike("[0-9]{3}|@") & (F.length("text") <= train_chars))
            .withColumn("_h", F.xxhash64("text")))
    first = some.select("_h").distinct().orderBy("_h").limit(train_docs)
    hashes = docs.sparkSession.createDataFrame(pa.table({"_f": pa.array([r._h for r in first.collect()], pa.int64())}))  # train_docs rows
    rows = some.join(F.broadcast(hashes), F.col("_h") == F.col("_f"), "left_semi").dropDuplicates(["_h"]).collect()
    return train([r.text for r in sorted(rows, key=lambda r: r._h)])


def found(docs: DataFrame, keys: list[str], weights: dict[str, float]) -> DataFrame:
    """``keys`` with base_n (counts per kind), base, spans (as text)."""
    names = [*keys, *[f"n_{k}" for k in KINDS], "base", "spans"]

    def run(batches):
        for b in batches:
            n = [[] for _ in KINDS]
            base, every = [], []
            for t in b.column(len(keys)).to_pylist():
                x, y = find(t or "", weights)
                for k in range(len(KINDS)):
                    n[k].append(sum(s[1] == k for s in x))
                base.append(shown(x))
                every.append(shown(y))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keys))), *(pa.array(c, pa.int64()) for c in n),
                                              pa.array(base, pa.string()), pa.array(every, pa.string())], names=names)

    src = docs.select(*keys, "text")
    schema = ", ".join([f"`{k}` {src.schema[k].dataType.simpleString()}" for k in keys]
                       + [f"n_{k} long" for k in KINDS] + ["base string", "spans string"])
    return src.mapInArrow(run, schema)


def masked(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets,
    and ``n_chars``, where there is such a column, counted anew."""
    cols = docs.columns
    at = cols.index("text")

    def run(batches):
        for b in batches:
            out = []
            for t in b.column(at).to_pylist():
                if t:
                    parts, last = [], 0
                    for s, k, e in find(t, weights)[1]:
                        if s >= last:
                            parts += [t[last:s], f"[{KINDS[k]}]"]
                        last = max(last, e)
                    t = "".join(parts) + t[last:] if parts else t
                out.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if i == at else b.column(i)
                                              for i in range(len(cols))], names=cols)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in cols else out


def find_personal_data(docs: DataFrame) -> DataFrame:
    """The digest per document."""
    return found(docs, ["doc_id"], fitted(docs)).select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
