import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarn.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
nasty = st.text(max_size=30) | st.lists(st.sampled_from(["<|im_end|>", "<|im_start|>", "<|", "|>", "\\", "<\\|", "\n", "assistant", "<", "|", "\\\\", "\\n"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant"]) | nasty, nasty), max_size=6))
def test_round_trip(turns):
    text, spans = chat.render(turns)
    assert chat.read_back(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert text.count(chat.START) == text.count(chat.END) == len(turns)


@pytest.mark.parametrize(
    ("record", "want"),
    [
        ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, [("user", "a"), ("assistant", "b")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
        ({"data": {"dialog": [{"speaker": "bot", "utterance": "b"}]}}, [("assistant", "b")]),
        ({"prompt": "a", "completion": "b"}, [("user", "a"), ("assistant", "b")]),
        ({"system": "s", "prompt": "a", "response": "b"}, [("system", "s"), ("user", "a"), ("assistant", "b")]),
        ({"instruction": "a", "input": "", "output": "b"}, [("user", "a"), ("assistant", "b")]),
        ({"instruction": "a", "input": "i", "output": "b"}, [("user", "a"), ("user", "i"), ("assistant", "b")]),
        ({"question": "a", "answer": "b"}, [("user", "a"), ("assistant", "b")]),
        # fields beside those of a layout do not hide it
        ({"id": 5, "meta": {"x": [1]}, "messages": [{"role": "human", "content": "a", "weight": 1}]}, [("human", "a")]),
        ({"messages": [{"role": "user", "content": ["a", 1]}, "b", {"role": None, "content": None}]}, [("user", '["a", 1]'), ("", "")]),
        ({"messages": "a", "prompt": "p", "completion": 7}, [("user", "p"), ("assistant", "7")]),
        # unknown layouts
        ({"messages": []}, None),
        ({}, None),
        ({"x": 1}, None),
        (["a"], None),
        ("a", None),
    ],
)
def test_layouts(record, want):
    assert chat.canonical(record) == want


def test_fingerprints_tell_layouts_apart():
    assert len(chat.REGISTRY) == len(chat.LAYOUTS)
    assert chat.fingerprint(chat.paths({"a": [{"b": 1}, {"c": {"d": 2}}]})) == chat.fingerprint({"a[].c.d", "a[].b"})
    assert chat.mapping_of({"x": 1}) is None


def test_records_of_many_layouts(spark):
    rows = [(1, json.dumps({"prompt": "a", "completion": "<|im_end|>"})), (2, json.dumps({"conversations": [{"from": "gpt", "value": "b"}]})), (3, None), (4, "{}"), (5, "no json"), (6, '{"messages": [{"role": "user", "content": ""}]}')]
    got = {r.conv_id: r for r in chat.format_records(spark.createDataFrame(rows, "conv_id long, record string")).collect()}
    assert chat.read_back(got[1].formatted) == [("user", "a"), ("assistant", "<|im_end|>")]
    assert chat.read_back(got[2].formatted) == [("assistant", "b")]
    assert all(got[i].formatted is None and got[i].loss_spans is None for i in (3, 4, 5))
    assert chat.read_back(got[6].formatted) == [("user", "")]
    empty = {r.conv_id: r for r in chat.digests(chat.format_records(spark.createDataFrame(rows, "conv_id long, record string"))).collect()}
    assert (empty[4].n_turns, empty[4].formatted_chars) == (0, 0)


def test_rows_become_records_of_their_own_layout(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "system", "s"), (2, 1, "user", "q"), (2, 2, "assistant", "a"), (3, 0, "user", "q"), (3, 1, "user", "r"), (4, 0, "user", ""), (4, 1, "assistant", "a")]
    got = {r.conv_id: json.loads(r.record) for r in chat.gathered(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == {"prompt": "q", "completion": "a"} and got[2] == {"system": "s", "prompt": "q", "response": "a"}
    assert len(got[3]["messages"]) == len(got[4]["messages"]) == 2
    for i, record in got.items():
        assert chat.canonical(record) == [(r, t) for k, _, r, t in rows if k == i]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_edges(spark, clashing):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "é\U0001f600"), (2, None, None, "x"), (2, 0, "user", "y"), (3, 0, "user", "a"), (3, 0, "user", "a"), (4, 0, "assistant", "z " * 50_000), (None, 0, "assistant", "n")]
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert set(got) == {1, 2, 3, 4, None, -1}
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_chars, got[1].loss_sha256) == (2, sha("user\né\U0001f600\nassistant\n\n"), 0, sha(""))
    assert got[2].turns_sha256 == sha("\nx\nuser\ny\n") and got[3].n_turns == 2
    assert got[4].loss_chars == 100_000 and got[4].loss_sha256 == sha("z " * 50_000)
    assert got[-1].turns_sha256 == sha(f"user\n{chat.PROBE}\nassistant\n{chat.PROBE}\n") and got[-1].loss_chars == len(chat.PROBE)
    assert [r.conv_id for r in chat.format_conversations(df.limit(0)).collect()] == [-1]


def test_whole_table(spark, sf_dir, oracle):
    oracle.same(chat.format_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet")), chat.ORACLE)
