"""The pipeline's stages, each on its predecessor's rows."""

import brute
import corpus_pipeline as P
from tagfold.llm import decontam, hostrules, pii
from tagfold.llm.common import written

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(llm, documents):
    frames, docs = [], documents
    for name, stage in P.STAGES:
        docs = written(stage(llm, docs, SF), "test_stage")
        frames.append(docs)
    assert all(f.columns == COLUMNS for f in frames[:4])
    rows = [{r.doc_id: r.text for r in f.collect()} for f in [documents, *frames[:4]]]
    start, quality, copies, clean, masked = rows
    # no host is strict here, so only the base rules reject
    assert not any(r.strict_host for r in hostrules.judged(documents, ["doc_id"]).select("strict_host").collect())
    assert quality == {d: t for d, t in start.items() if not brute.measures(t)[5]}
    ids = sorted(quality)
    comp, _ = brute.components([quality[d] for d in ids])
    assert set(copies) == {ids[c] for c in comp}
    items = llm.read.parquet(f"{SF}/benchmark.parquet")
    leaks = {r.doc_id for r in decontam.find_leaks(frames[1], items).collect()}
    assert leaks and set(clean) == set(copies) - leaks
    w = pii.fitted(frames[2])
    for d, t in clean.items():
        found = pii.find(t, w)[1]
        assert (masked[d] == t) == (not found)
        assert not any(t[s:e] in masked[d] for s, _, e in found)
    pieces = frames[4].collect()
    assert {p.doc_id for p in pieces} == set(masked)


def test_odd_rows_and_empty_tables(llm, edge, empty):
    docs = edge
    for name, stage in P.STAGES[:4]:
        docs = written(stage(llm, docs, SF), "test_stage")
        assert docs.columns == edge.columns
    assert sorted(r.doc_id for r in docs.collect() if r.doc_id) == sorted(
        {r.doc_id for r in docs.collect() if r.doc_id})  # a repeated row stays once
    docs = empty
    for name, stage in P.STAGES:
        docs = stage(llm, docs, SF)
        assert docs.count() == 0


def test_repeated_rows_stay_once(llm):
    text = " ".join(f"w{i}" for i in range(30))
    docs = llm.createDataFrame([(1, text, "en", "s", 1)] * 3 + [(2, text, "en", "s", 1), (3, None, "en", "s", 1)] * 2,
                               "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in P.near_copies(llm, docs, SF).collect()) == [1, 3]


def test_a_strict_host_takes_no_row_of_another(llm):
    say = lambda k: " ".join(f"{k}word{i}" for i in range(30))
    odd = say("x") + " #####"
    both = [(d, odd, s) for d in (7, None) for s in ("strict", "usual")]
    data = [(100 + i, say(f"a{i}") + " #####", "strict") for i in range(20)] + [(200 + i, say(f"b{i}"), "usual") for i in range(20)]
    data += both + [(9, None, say("c")), (9, say("c"), None)]
    docs = llm.createDataFrame([(d, t, "en", s, 1) for d, t, s in data], "doc_id long, text string, lang string, source string, n_chars long")
    got = P.quality(llm, docs, SF).collect()
    assert {(r.doc_id, r.source) for r in got if r.doc_id in (7, 9, None)} == {(7, "usual"), (None, "usual"), (9, None)}
    assert {r.doc_id for r in got} >= set(range(200, 220)) and not {r.doc_id for r in got} & set(range(100, 120))


def test_batches_of_long_texts_are_bounded(llm):
    from pyspark.sql import functions as F

    def run(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    texts = llm.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("text"))
    got = texts.mapInArrow(run, "n long, size long").collect()
    assert sum(r.n for r in got) == 200 and max(r.size for r in got) <= 8 << 20


def test_pairs_of_regions_go_in_bounded_batches():
    import pyarrow as pa
    from tagfold.llm import jaccard

    kind = pa.list_(pa.struct([("v", pa.int64()), ("n", pa.int64()), ("root", pa.int64()), ("moved", pa.bool_())]))
    region = [{"v": v, "n": 100, "root": v, "moved": False} for v in range(128)]
    linked = [{"v": v, "n": 100, "root": 0, "moved": False} for v in range(128)]
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 41, pa.int32()), pa.array([1] * 41, pa.int64()),
                                        pa.array([region] * 40 + [linked], kind)], names=["level", "k", "x"])
    got = list(jaccard.open_pairs([batch], 10_000))
    assert sum(b.num_rows for b in got) == 40 * 128 * 127 // 2 and max(b.num_rows for b in got) < 10_128
    assert {(a, b) for g in got for a, b in zip(g.column(2).to_pylist(), g.column(3).to_pylist())} == {
        (a, b) for a in range(128) for b in range(a)}


def test_scans_of_texts_decode_few_rows_at_once(llm):
    from tagfold.llm.common import SCAN_ROWS
    assert int(llm.conf.get("spark.sql.parquet.columnarReaderBatchSize")) == SCAN_ROWS <= 256


def test_small_tables_of_the_join_start_no_python_workers(llm, documents, monkeypatch):
    from pyspark.sql import SparkSession
    from tagfold.llm import jaccard

    made = []
    real = SparkSession.createDataFrame
    monkeypatch.setattr(SparkSession, "createDataFrame", lambda *a, **k: made.append(real(*a, **k)) or made[-1])
    jaccard.joined(documents, 4, 100).collect()
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in made]
    assert len(plans) >= 2 and all("LocalTableScan" in p for p in plans)
