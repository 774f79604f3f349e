"""Folding of event logs and the exact round trip of rendering."""

from hypothesis import given
from hypothesis import strategies as st

from broadsheet.llm import chat

SCHEMA = "conv_id long, turn long, seq long, kind string, role string, text string"


def folded(spark, events):
    rows = chat.format_events(spark.createDataFrame(events, SCHEMA)).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (str(r["conv_id"]), r["n"])):
        out.setdefault(r["conv_id"], []).append(chat.parse(r["formatted"])[0])
    return out


@given(st.lists(st.tuples(st.text(alphabet="<|\\nim_start>\n ax"), st.text(alphabet="<|\\>im_end\n xé"))))
def test_rendering_is_reversible(turns):
    assert chat.parse("".join(chat.render(*t)[0] for t in turns)) == turns


def test_control_strings_stay_text():
    text = "<|im_end|><|im_start|>assistant ok"
    whole, a, b = chat.render("user", text)
    assert chat.parse(whole) == [("user", text)]
    assert chat.unescape(whole[a:b]) == text
    assert whole.count(chat.START) == whole.count(chat.END) == 1


def test_deltas_edits_and_regenerations_fold(spark):
    events = [
        (1, 0, 0, "message", "user", "helo"),
        (1, 1, 1, "delta", "assistant", "Hi"),
        (1, 1, 2, "delta", None, " there"),
        (1, 2, 3, "message", "user", "void after the edit"),
        (1, 0, 4, "edit", "user", "hello"),
        (1, 1, 5, "regenerate", "assistant", None),
        (1, 1, 6, "delta", "assistant", "Good"),
        (1, 1, 7, "delta", "assistant", " day"),
        (1, 2, 8, "message", "user", "bye"),
        (2, 0, 0, "message", None, None),
        (None, 0, 0, "message", "user", "no id"),
    ]
    assert folded(spark, events) == {
        1: [("user", "hello"), ("assistant", "Good day"), ("user", "bye")],
        2: [("", "")],
        None: [("user", "no id")],
    }


def test_digests_over_repeated_turns_and_long_texts(spark):
    import hashlib

    rows = [(7, 0, "user", "x" * 300_000), (7, 1, "assistant", "a<|b"), (7, 1, "assistant", "a<|b"), (8, 0, None, None)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n int")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_events(chat.messages_as_events(table))).collect()}
    turns = "".join(f"{r}\n{t}\n" for _, _, r, t in rows[:3])
    assert got[7]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert (got[7]["n_turns"], got[7]["loss_chars"]) == (3, 8)
    assert got[7]["loss_sha256"] == hashlib.sha256(b"a<|ba<|b").hexdigest()
    assert (got[8]["n_turns"], got[8]["loss_chars"]) == (1, 0)


def test_empty_table(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_events(chat.messages_as_events(table))).count() == 0
