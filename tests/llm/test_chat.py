import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dwellspark.llm import chat
from dwellspark.llm.queries import HOSTILE

PIECES = st.lists(
    st.sampled_from(["<|im_end|>", "<|im_start|>", "<|", "<\\|", "<\\\\|", "\\s", "\\n", "\n", "a", "é", "assistant", "|>", "<", "\\", ""]), max_size=6
).map("".join)


def expected(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    lines = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), hashlib.sha256(lines.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), PIECES), PIECES), min_size=1, max_size=3), min_size=30, max_size=40))
def test_round_trip(spark, conversations):
    rows = [(i, j, r, t) for i, turns in enumerate(conversations) for j, (r, t) in enumerate(turns)]
    chats = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.chat_digest(chats).collect()}
    assert got == {i: expected(turns) for i, turns in enumerate(conversations)}


def test_levels_and_no_control_string_inside(spark):
    rows = [(1, 0, "user", "plain < | text"), (-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE), (2, 0, "a\nb", "x")]
    got = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {i: r["level"] for i, r in got.items()} == {1: 0, -1: 1, 2: 2}
    assert got[-1]["formatted"].count("<|im_start|>") == 2 and got[-1]["formatted"].count("<|im_end|>") == 2
    assert got[1]["formatted"] == "<|im_start|>user\nplain < | text<|im_end|>\n"


def test_nulls_ties_repeats_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, n_turns string"
    rows = [(1, None, None, None, "c"), (1, 0, "user", "b", "c"), (1, 0, "user", "a", "c"), (1, 0, "user", "a", "c"), (None, 1, "assistant", "z", "c")]
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.chat_digest(chat.format_chats(spark.createDataFrame(rows, schema))).collect()}
    assert got == {1: expected([("", ""), ("user", "a"), ("user", "a"), ("user", "b")]), None: expected([("assistant", "z")])}
    assert chat.chat_digest(chat.format_chats(spark.createDataFrame([], schema))).count() == 0
