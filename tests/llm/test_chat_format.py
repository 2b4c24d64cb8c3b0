import itertools

from pyspark.sql import functions as F

from eventpipe.llm.chat_format import CONTROL, format_conversations, parse, read_back, render

KIND = "conv_id bigint, turn bigint, role string, text string"


def test_every_control_string_in_every_place_comes_back(spark):
    bodies = [a + m + b for m in CONTROL for a, b in itertools.product(("", "x ", "<", "&lt;"), ("", " y", "]", "&"))]
    bodies += ["", "&amp;lt;", "&bar;", "<", "[", "|>", "<|", "\n", "[[INST]", "</s", "x" * 100_000]
    roles = ["user", "assistant", "system", "tool", "a|>b", "", "<s>"]
    rows = [(i, t, roles[(i + t) % len(roles)], body) for i, body in enumerate(bodies) for t in range(3)]
    formatted = format_conversations(spark.createDataFrame(rows, KIND))
    back = {r.conv_id: r for r in read_back(formatted).collect()}
    for i, body in enumerate(bodies):
        expected = [(roles[(i + t) % len(roles)], body) for t in range(3)]
        assert [(t.role, t.text) for t in back[i].turns] == expected
        assert back[i].loss_text == "".join(text for role, text in expected if role == "assistant")
        runs = sum(m.head_chars + m.body_chars + m.end_chars for m in back[i].loss_mask)
        assert runs == len(back[i].formatted)
        assert back[i].level <= 1


def test_no_control_string_is_left_in_a_body(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "plain")]
    text = read_back(format_conversations(spark.createDataFrame(rows, KIND))).first().formatted
    assert text == "[INST]&lt;/s>&lsb;INST] ok &lsb;/INST][/INST]<s>plain</s>"


def test_all_levels_read_back(spark):
    turns = F.array(F.struct(F.lit("user").alias("role"), F.lit("a<b[c|d&e").alias("text")))
    for level in range(3):
        got = spark.range(1).select(parse(render(turns, level)).alias("t")).first().t
        assert [(t.role, t.text) for t in got] == [("user", "a<b[c|d&e")]


def test_nulls_repeats_order_and_empty_table(spark):
    rows = [(1, 2, "user", "c"), (1, 0, None, None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (None, 0, "user", "z"), (1, None, "user", "first")]
    back = {r.conv_id: r for r in read_back(format_conversations(spark.createDataFrame(rows, KIND))).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("user", "first"), ("", ""), ("assistant", "b"), ("assistant", "b"), ("user", "c")]
    assert back[1].loss_text == "bb"
    assert [(t.role, t.text) for t in back[None].turns] == [("user", "z")]
    assert read_back(format_conversations(spark.createDataFrame([], KIND))).collect() == []


def test_clashing_extra_columns(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a", "x", 1)], KIND + ", formatted string, turns int")
    assert read_back(format_conversations(frame)).first().formatted == "[INST]a[/INST]"
