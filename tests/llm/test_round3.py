"""WARC archives, spelling variants and the Merkle manifest against plain
Python, on the smallest table, on odd rows and on an empty table."""

import collections
import gzip
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import brute
from tagfold.llm import merkle, shards, spelling, warc
from tagfold.session import scratch_path


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(params=["documents", "edge", "empty"])
def docs(request):
    return request.getfixturevalue(request.param)


# ---------------------------------------------------------------- WARC

BODY = "<p>" + "same page " * 30 + "</p>"
PAGES = [
    (1, "http://a/1", BODY), (2, "http://a/2", BODY), (2, "http://a/2", BODY), (None, "http://a/0", BODY),
    (3, None, None), (4, "http://a/4 x\r\nX: y", ""), (5, "u", "short"), (6, "u", "short"),
    (7, "u", "\r\n" * 9000), (8, "u", "a\r" * 8191 + "\n\r\n\r"), (9, "u", "é" * 30_001), (10, "u", "0\r\n\r\n\r\nWARC/1.1\r\n" * 50),
    (11, "u", "x" * warc.CHUNK), (12, "u", "x" * (3 * warc.CHUNK + 1)), (13, "u", "x" * (warc.CHUNK - 1) + "\r\n"),
    (14, "u", "y" * 99), (15, "u", "y" * 99), (16, "u", "y" * 100), (17, "u", "y" * 100), (0, "u", BODY + " "),
]


@pytest.fixture(scope="module")
def pages(llm):
    extra = "rec long, data string, digest string, n_bytes int, chunk_no int"
    return llm.createDataFrame([(*p, *[None] * 5) for p in PAGES], "page_id long, url string, html string, " + extra)


def want_pages(pairs):
    groups = collections.defaultdict(list)
    for p, t in pairs:
        raw = (t or "").encode()
        groups[hashlib.sha256(raw).hexdigest(), len(raw)].append(p)
    out = []
    for (d, n), ids in groups.items():
        ids.sort(key=lambda p: (p is None, p))
        out += [(p, n, d, *(("revisit", ids[0]) if k and n >= 100 else ("response", None))) for k, p in enumerate(ids)]
    return collections.Counter(out)


def got_pages(df):
    return collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def test_archive(llm, pages):
    assert got_pages(warc.archive_pages(pages)) == want_pages([(p, t) for p, _, t in PAGES])
    table = llm.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert got_pages(warc.archive_pages(table)) == want_pages([(r.page_id, r.html) for r in table.collect()])
    assert warc.archive_pages(pages.limit(0)).collect() == []


def test_chunks_carry_their_digest_and_come_back(llm, pages):
    from tagfold.llm.common import written
    chunks = written(warc.chunk_table(pages), "t_chunks")
    texts = collections.defaultdict(bytes)
    for r in sorted(chunks.collect(), key=lambda r: (r.rec, r.chunk_no)):
        texts[r.rec] += r.data
        assert len(r.data) <= warc.CHUNK and r.digest == hashlib.sha256(texts[r.rec]).hexdigest()
    assert sorted(texts.values()) == sorted((t or "").encode() for _, _, t in PAGES)
    path = scratch_path(llm, "t_warc")
    warc.write_archive(chunks, warc.record_heads(chunks), path)
    back = collections.defaultdict(bytes)
    for r in sorted(warc.read_chunks(llm, path).collect(), key=lambda r: (r.record_id, r.chunk_no)):
        back[r.record_id] += r.data
        assert r.digest == hashlib.sha256(back[r.record_id]).hexdigest()
    full = {r.record_id: r.page_id for r in warc.read_records(llm, path).collect() if r.record_type == "response"}
    assert collections.Counter((full[k], v) for k, v in back.items()) == collections.Counter(
        (p, t.encode()) for p, n, d, kind, _ in want_pages([(p, t) for p, _, t in PAGES]).elements() if kind == "response"
        for t in [next((x or "") for q, _, x in PAGES if q == p and hashlib.sha256((x or "").encode()).hexdigest() == d)] if t)


def test_files_are_archives(llm, pages):
    """Records delimited by Content-Length alone, as any reader does it."""
    import glob
    from tagfold.llm.common import written
    chunks = written(warc.chunk_table(pages), "t_chunks")
    path = scratch_path(llm, "t_warc")
    warc.write_archive(chunks, warc.record_heads(chunks), path)
    kinds = collections.Counter()
    for name in glob.glob(path.removeprefix("file:") + "/*.gz"):
        raw = gzip.open(name).read()
        while raw:
            head, raw = raw.split(b"\r\n\r\n", 1)
            assert head.startswith(b"WARC/1.1\r\n")
            n = int(re.search(rb"Content-Length: (\d+)", head)[1])
            assert raw[n:n + 4] == b"\r\n\r\n"
            kinds[re.search(rb"WARC-Type: (\w+)", head)[1].decode()] += 1
            raw = raw[n + 4:]
    want = collections.Counter(k for _, _, _, k, _ in want_pages([(p, t) for p, _, t in PAGES]).elements())
    assert kinds["response"] == want["response"] and kinds["revisit"] == want["revisit"]


def test_broken_archives_are_errors():
    h = {"rec": 1, "page_id": 1, "url": "u", "n_bytes": 3, "digest": "x", "first_rec": None, "first_page": None}
    lines = [*warc.head_lines(h, 10), b"3", b"abc", b"0", b"", b"", b""]
    assert [k for k, _ in warc.parsed(lines)] == ["head", "data", "end"]
    for bad in (lines[:-4], [*lines[:-5], b"abcd", *lines[-4:]], lines[1:]):
        with pytest.raises(ValueError):
            list(warc.parsed(bad))


# ---------------------------------------------------------------- spelling

def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def want_words(pairs):
    n = collections.Counter()
    for d, t in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2 and len(w) >= 7}
    nears = collections.defaultdict(set)
    by_cut = collections.defaultdict(set)
    for w in n:
        for c in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))} if len(w) < 200 else {w}:
            by_cut[c].add(w)
    for group in by_cut.values():
        for a in group:
            nears[a] |= {b for b in group if near(a, b)}
    form = {}
    for w in n:
        best = min(nears[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(nears[w]), n[form[w]] if form[w] else None) for w in n}


def test_spelling(docs):
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(docs).collect()]
    assert len(got) == len(set(got))
    assert set(got) == want_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def _typo(rng, w):
    k, c = rng.randrange(len(w) + 1), rng.choice("abé")
    return rng.choice([w[:k] + c + w[k:], w[:k] + w[k + 1:], w[:k] + c + w[k + 1:]])


def test_spelling_of_hot_lists_long_words_and_chains(llm, monkeypatch):
    monkeypatch.setattr(spelling, "LIST", 6)
    rng = random.Random(4)
    words = ["".join(rng.choice("ab") for _ in range(rng.choice((7, 8, 9)))) for _ in range(120)]
    for size in (62, 63, 64, 65, 66, 67, 90):
        long = "".join(rng.choice("abcd") for _ in range(size))
        words += [long, long + "x", "x" + long, long[:30] + "y" + long[31:], long[:-1]]
    words += [_typo(rng, w) for w in words for _ in range(4)]
    words += ["internatiOnal", "Über" * 3, "ÜBER" * 3]
    counted = [w for w in words for _ in range(rng.choice((2, 3, 25)))] + ["chainword"] * 3000 + ["chainwordx"] * 250 + [
        "chainwordxy"] * 20 + ["chainwordxyz"] * 2
    rng.shuffle(counted)
    pairs = [(k if k % 9 else None, " ".join(counted[k::40])) for k in range(40)] + [(50, " ".join(["z" * 30_000] * 3))]
    df = llm.createDataFrame(pairs, "doc_id long, text string")
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(df).collect()}
    assert got == want_words(pairs)
    assert any(w == "chainwordxyz" and r == "chainword" for w, _, r, *_ in got)


def test_bounds_leave_every_near_word_a_common_list():
    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(7, 12))) for _ in range(300)]
    for least in (1, 5, 40, 10**9):
        count = collections.Counter(w[p:p + q] for w in words for q in (2, 3, 4) for p in range(len(w) - q + 1))
        frequent = {g: n for g, n in count.items() if n > least}
        for w in words:
            g = spelling.grams_of(w, frequent)
            assert len(g) == len(w) - 1 and 1 <= spelling.affected(g) < len(g)
            t = _typo(rng, w)
            lists = lambda x: {(c > 0, x[:c] if c > 0 else x[c:]) for c in spelling.list_entries(x, frequent)}
            if len(t) >= 7 and t != w:
                assert lists(w) & lists(t), (w, t)


def test_long_texts_are_read_in_slices(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh") if rng.random() < 0.9 else rng.choice(" 1é") for _ in range(5000))
    whole = spelling.raw_runs(text)
    monkeypatch.setattr(spelling, "SLICE", 11)
    assert spelling.raw_runs(text) == whole


# ---------------------------------------------------------------- Merkle

def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def tree(nodes):
    """(root, [siblings of each leaf by level], [places])"""
    sibs, places = [[] for _ in nodes], [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        new, new_under = [], []
        for s in range(0, len(nodes), 16):
            run = nodes[s:s + 16]
            for k in range(len(run)):
                for leaf in under[s + k]:
                    sibs[leaf].append("".join(run[:k] + run[k + 1:]))
                    places[leaf].append(k)
            new.append(H("".join(run)))
            new_under.append([x for u in under[s:s + 16] for x in u])
        nodes, under = new, new_under
    return nodes[0], sibs, places


def want_manifest(docs):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, t: H("".join(map(field, (d.doc_id, d.source, d.lang, d.n_chars, t))))
    by = collections.defaultdict(list)
    for d in docs:
        by[(b"" if d.source is None else b"+" + d.source.encode())].append(d)
    trees = {}
    for s in sorted(by):
        by[s].sort(key=lambda d: (d.doc_id is not None, d.doc_id or 0, leaf(d, d.text)))
        trees[s] = tree([leaf(d, d.text) for d in by[s]])
    if not trees:
        return collections.Counter()
    root, up, up_places = tree([trees[s][0] for s in sorted(trees)])
    out = collections.Counter()
    for k, s in enumerate(sorted(trees)):
        for i, d in enumerate(by[s]):
            steps = list(zip(trees[s][2][i] + up_places[k], trees[s][1][i] + up[k]))
            t = d.text
            if d.doc_id is not None and zlib.crc32(str(d.doc_id).encode()) % 5 == 0 and t is not None:
                t = t.translate(brute.LOWER)
            cur = leaf(d, t)
            for p, x in steps:
                cur = H(x[:64 * p] + cur + x[64 * p:])
            out[d.doc_id, leaf(d, d.text), trees[s][0], root, H("".join(x for _, x in steps)), cur, cur == root] += 1
    return out


def got_manifest(docs):
    return collections.Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
                               for r in merkle.merkle_proofs(docs).collect())


def test_manifest(docs):
    assert got_manifest(docs) == want_manifest(docs.select("doc_id", "source", "lang", "n_chars", "text").collect())


def test_manifest_of_many_sizes(llm):
    """A hot source of three rounds' height, sources of 1, 16, 17, 256 and 257
    documents, and more sources than a run holds."""
    sizes = {"hot": 4200, "b256": 256, "b257": 257, "c16": 16, "c17": 17, None: 3, "": 2, "é": 1} | {f"s{i}": 1 + i % 3 for i in range(300)}
    data = [(None if i == 5 else i * 7 % 100_003, s, "en", i, f"Text {i} {s}") for s, n in sizes.items() for i in range(n)]
    random.Random(3).shuffle(data)
    df = llm.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert got_manifest(df) == want_manifest(df.collect())


def test_log_is_gapless_and_addressed_by_size(llm):
    data = [(i, "hot" if i < 600 else f"s{i % 4}", "en", 1, f"T{i}") for i in range(700)]
    df = llm.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string")
    lower, _ = merkle.manifest(df)
    logs = collections.defaultdict(dict)
    for r in merkle.log_rows(lower).collect():
        assert r.pos not in logs[r.tree]
        logs[r.tree][r.pos] = (r.level, r.idx, r.digest)
    for t, log in logs.items():
        n = sum(1 for level, _, _ in log.values() if level == 0)
        whole = merkle.append_log([d for _, _, d in sorted((x for x in log.values() if x[0] == 0), key=lambda x: x[1])], merkle.height(n))
        assert [log[i][2] for i in range(len(log))] == whole


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 272, 273, 4096, 4097])
def test_postorder_positions(n):
    top = merkle.height(n)
    log = merkle.append_log([str(i) for i in range(n)], top)
    seen = {merkle.postorder(k, i, n, top) for k in range(top + 1) for i in range(-(-n // 16 ** k))}
    assert seen == set(range(len(log)))
    assert all(log[merkle.postorder(0, i, n, top)] == str(i) for i in range(n))


# ---------------------------------------------------------------- shards, token ids

def _loads(got):
    load = collections.Counter({s: 0 for s in range(16)})
    for r in got:
        load[r["shard"]] += r["size"]
    return load


def test_bytes_law_holds_where_rows_repeat(llm):
    """A third under one id, another sixth one and the same row, null ids."""
    rng = random.Random(6)
    data = [(7, "x" * rng.randrange(2000)) for _ in range(2000)] + [(8, "same row " * 90)] * 1000 + [
        (None, "y" * rng.randrange(2000)) for _ in range(500)] + [(i + 10, "z" * rng.randrange(2000)) for i in range(2500)]
    df = llm.createDataFrame(data, "doc_id long, text string").repartition(7)
    got = rows(shards.shard_documents(df))
    load, places = _loads(got), collections.defaultdict(list)
    assert max(load.values()) - min(load.values()) <= 2000
    for r in got:
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert collections.Counter((r["doc_id"], r["size"]) for r in got) == collections.Counter((d, len(t) + 1) for d, t in data)


def test_the_stored_map_is_edited(llm):
    """A run on grown data reads the map, moves few slots and writes the next
    version; a run on the same data writes none."""
    path = scratch_path(llm, "t_map")
    df = llm.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("t"), (F.col("id") % 90).cast("int")).alias("text"))
    first = {r.doc_id: r.shard for r in shards.sharded(df, map_path=path).collect()}
    assert shards.latest_map(llm, path)[0] == 1
    again = {r.doc_id: r.shard for r in shards.sharded(df, map_path=path).collect()}
    assert again == first and shards.latest_map(llm, path)[0] == 1
    grown = df.unionByName(llm.range(3000, 4000).select(F.col("id").alias("doc_id"), F.lit("more" * 9).alias("text")))
    got = rows(shards.sharded(grown, map_path=path))
    moved = sum(first[r["doc_id"]] != r["shard"] for r in got if r["doc_id"] < 3000)
    load = _loads(got)
    assert moved < 300 and max(load.values()) - min(load.values()) < 0.05 * max(load.values())
    more = rows(shards.sharded(grown, n_shards=17, map_path=path))
    assert {r["shard"] for r in more} == set(range(17)) and {r["map_version"] for r in more} == {shards.latest_map(llm, path)[0]}


def test_ids_of_special_strings_are_the_tokenizers():
    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer
    from tagfold.llm import packing, tokens
    texts = ["a<|endoftext|>b", "<|startoftext|>", "x <|endoftext|> <|endoftext|>. Y", "<|endoftext|", "(<|startoftext|>)Caf\u00e9<|endoftext|>", "<|EndOfText|>"]
    plain = Tokenizer.from_file(packing.tokenizer_path())
    got, ends = tokens.WordIds(packing.tokenizer_path()).ids(pa.array(texts))
    for i, t in enumerate(texts):
        assert got[ends[i]:ends[i + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids, t
    assert np.any(got == 49407)


# ---------------------------------------------------------------- host rules

def test_hosts_are_judged_against_the_corpus(llm):
    """One of thirty hosts fails the symbol rule in a fifth of its documents
    where others do in a fiftieth: it alone is strict, in that rule alone."""
    from tagfold.llm import hostrules
    words = [f"word{i}" for i in range(40)]
    clean, symbols, lines = " ".join(words), " ".join(f"w#{i}" for i in range(40)), "one line of words\n" * 3 + " ".join(words)
    data = []
    for h in range(30):
        for i in range(200):
            bad = i < (40 if h == 7 else 4)
            data.append((h * 1000 + i, symbols if bad else lines if i == 199 else clean, f"h{h}"))
    data += [(50_000 + i, symbols, "tiny") for i in range(2)]  # too few documents to tell
    df = llm.createDataFrame(data, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in hostrules.judged(df, ["doc_id"]).collect()}
    changed = {d for d, r in got.items() if r.kept == r.base_failed}
    assert changed == {7000 + i for i in range(40)}
    assert {r.source for r in got.values() if r.strict_host} == {"h7"}
