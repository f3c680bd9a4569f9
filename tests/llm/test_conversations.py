"""Preference formatting against the SQL and on odd rows."""

import duckdb
import pytest

from tagfold.llm import preference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("operator, sql", [(preference.format_preferences, preference.PAIRED_ORACLE),
                                           (preference.format_derived_preferences, preference.ORACLE)])
def test_matches_the_sql(llm, operator, sql):
    got = operator(llm.read.parquet(f"{SF}/conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    assert sorted(got.columns) == sorted(cols)
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(cur.fetchall())


def test_derived_pairs_share_all_but_the_last_answer(llm):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "more"), (0, 3, "assistant", "good"),
            (0, 4, "user", "thanks"), (0, 4, "user", "thanks"), (1, 0, "user", "x"), (1, 1, "assistant", "bad"),
            (2, 0, "user", "no answer"), (3, 0, "assistant", "unused"), (4, None, "assistant", "no turn"), (5, 0, "assistant", None),
            (6, 0, "assistant", "same"), (7, 0, "assistant", "same"), (None, 0, "user", "x"), (9, None, None, None)]
    df = llm.createDataFrame([(*r, "clash", 0) for r in rows],
                             "conv_id long, turn long, role string, text string, side string, last int")
    got = {(r.pair_id, r.part): r for r in preference.format_derived_preferences(df).collect()}
    prompt = "<|user|>\nhi<|end|>\n<|assistant|>\nyes<|end|>\n<|user|>\nmore<|end|>\n"
    tail = "<|end|>\n<|user|>\nthanks<|end|>\n"
    assert got[0, "prompt"].rendered == prompt
    assert got[0, "chosen"].rendered == "<|assistant|>\ngood" + tail
    assert got[0, "rejected"].rendered == "<|assistant|>\nbad" + tail
    a, z = map(int, got[0, "rejected"].loss_mask.split(":"))
    assert got[0, "rejected"].rendered[a:z] == "bad<|end|>\n"
    assert got[1, "rejected"].rendered == "<|assistant|>\ngood<|end|>\n"
    assert {p for k, p in got if k in (2, 3, 6, 7, 9)} == {"prompt"}
    assert got[4, "rejected"].rendered == "<|assistant|>\n<|end|>\n" and got[5, "rejected"].rendered == "<|assistant|>\nno turn<|end|>\n"
    assert None not in {k for k, _ in got} and preference.format_derived_preferences(df.limit(0)).collect() == []


def test_prefix_is_rendered_once_and_masks_cover_the_assistant(llm):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "more"), (0, 3, "assistant", "good"),
            (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "more"), (1, 3, "assistant", "bad"),
            (1, 3, "assistant", "bad"), (4, 0, "user", "alone"), (6, 0, None, None), (7, 0, None, None), (None, 0, "user", "x"),
            (8, None, "user", "first"), (8, 0, "user", "then"), (9, None, "user", "first")]
    df = llm.createDataFrame([(*r, "clash", "clash") for r in rows],
                             "conv_id long, turn long, role string, text string, pair_id string, part string")
    got = {(r.pair_id, r.part): r for r in preference.format_preferences(df).collect()}
    prompt, good, bad = got[0, "prompt"], got[0, "chosen"], got[0, "rejected"]
    assert prompt.rendered == "<|user|>\nhi<|end|>\n<|assistant|>\nyes<|end|>\n<|user|>\nmore<|end|>\n" and prompt.loss_mask == ""
    for r, word in ((good, "good"), (bad, "bad")):
        a, z = map(int, r.loss_mask.split(":"))
        assert r.rendered[a:z] == word + "<|end|>\n" and r.n_turns == 1
    assert (2, "prompt") not in got and got[2, "chosen"].n_turns == 1
    assert got[3, "prompt"].rendered == "<||>\n<|end|>\n" and (3, "chosen") not in got
    assert got[4, "prompt"].n_turns == 1 and got[4, "chosen"].n_turns == 1
    assert None not in {p for p, _ in got}
    assert preference.format_preferences(df.limit(0)).collect() == []


def test_long_and_crowded_conversations_are_split(llm):
    rows = [(0, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(300)] + \
           [(1, t, "assistant" if t % 2 else "user", f"t{t}" if t < 250 else f"u{t}") for t in range(300)] + \
           [(2, 0, "user", f"many {i}") for i in range(500)]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = preference.format_preferences(df).collect()
    assert max(r.n_turns for r in got) <= 130
    prompt = "".join(r.rendered for r in sorted((r for r in got if (r.pair_id, r.part) == (0, "prompt")), key=lambda r: r.first_turn))
    assert prompt.count("<|end|>") == 250 and prompt.index("t0") < prompt.index("t249")
    assert sum(r.n_turns for r in got if r.pair_id == 1) == 500
