import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import chat
from tests.llm.helpers import SF, write_tables
from tools.compare import compare_one, duck

text = st.text(alphabet=st.sampled_from(list("ab\\<>/#\n turnimage0é")), max_size=30)


def test_query_matches_oracle(spark):
    res = compare_one(spark, duck(SF), "op4_chat_parts", SF, chat.QUERIES, chat.ORACLE)
    assert res["status"] == "ok", res


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(text, text), max_size=4))
def test_round_trip_of_any_texts(turns):
    v = chat.PartVisitor()
    for i, (role, content) in enumerate(turns):
        v.message(i, role, content)
    back = chat.read_back("".join(v.out))
    assert [(r, "".join(x for _, x in parts)) for r, parts in back] == turns


def test_typed_parts_become_placeholders_in_order():
    v = chat.PartVisitor()
    v.message(0, "user", [{"type": "text", "text": "see <image 0>"}, {"type": "image", "uri": "a.png", "width": 28, "height": 15},
                          {"type": "document", "uri": "b.pdf", "pages": 2}])
    v.message(1, "assistant", [{"type": "audio", "uri": "c.wav", "seconds": 1.5}, {"type": "text", "text": "done"}])
    assert chat.read_back("".join(v.out)) == [
        ("user", [("text", "see <image 0>"), ("image", 0), ("document", 1)]),
        ("assistant", [("audio", 2), ("text", "done")])]
    assert [(a["type"], a["uri"], a["turn"], a["tokens"]) for a in v.attachments] == [
        ("image", "a.png", 0, 4), ("document", "b.pdf", 0, 2048), ("audio", "c.wav", 1, 38)]
    assert v.tokens == 3 + 4 + 2048 + 38 + 1
    whole = "".join(v.out)
    assert [whole[s["start"]:s["end"]] for s in v.loss] == ["done"]
    with pytest.raises(ValueError, match="unknown part"):
        v.message(2, "user", [{"type": "video"}])


def test_parts_column_on_spark(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", [("text", "hi", None, None, None, None, None), ("image", None, "u", 14, 14, None, None)])],
        f"conv_id long, turn long, role string, content {chat.PARTS}")
    row = chat.format_conversations(df, content="content").first()
    assert row["formatted"] == "<turn user>\nhi<image 0></turn>\n" and row["attachments"][0]["uri"] == "u"


def test_edges(spark, tmp_path):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "assistant", None), (2, 1, "assistant", "a\\<b"),
            (None, 0, "user", ""), (2, 0, "user", "x" * 200_000)]
    folder = write_tables(spark, tmp_path, conversations=spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in chat.op4_chat_parts(spark, folder).collect()}
    assert set(got) == {1, 2, None, -7} and got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 0
    assert got[2]["loss_sha256"] == hashlib.sha256(b"a\\<b").hexdigest()
    assert got[2]["turns_sha256"] == hashlib.sha256(("user\n" + "x" * 200_000 + "\nassistant\na\\<b\n").encode()).hexdigest()
    assert got[-7]["loss_chars"] == len(chat.EXTRA_TEXT)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(empty).collect() == []


def test_long_conversations_are_streamed_turn_by_turn(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"<{t}> \\ a") for c in (5, None) for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_conversations(df).collect()
    assert len(got) == 600
    for c in (5, None):
        turns = sorted((r for r in got if r["conv_id"] == c), key=lambda r: r["position"])
        v = chat.PartVisitor()
        for t in range(300):
            v.message(t, "assistant" if t % 2 else "user", f"<{t}> \\ a")
        assert "".join(r["formatted"] for r in turns) == "".join(v.out)
        assert [s.asDict() for r in turns for s in r["loss"]] == v.loss
        assert sum(r["n_tokens"] for r in turns) == v.tokens


def test_words_end_at_ascii_spaces_only():
    v = chat.PartVisitor()
    v.message(0, "user", [{"type": "text", "text": "a b c d\x1ce\tf"}])
    assert v.tokens == 3
