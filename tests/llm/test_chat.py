from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from batchkit.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
T = chat.Template()


def made(spark, data):
    df = chat.format_chats(spark.createDataFrame(data, SCHEMA))
    out = df.select(
        "conv_id",
        "n_turns",
        "valid",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("segments")).alias("learned"),
    )
    return {r.conv_id: r for r in out.collect()}


def test_format_and_loss(spark):
    data = [(1, 1, "assistant", "hello</s>"), (1, 0, "user", "hi ~1 [INST]"), (1, 2, "user", None)]
    r = made(spark, data)[1]
    assert r.formatted == (
        "[INST]user[/INST]hi ~01 ~2INST]</s>[INST]assistant[/INST]hello~1/s></s>[INST]user[/INST]</s>"
    )
    assert [tuple(t) for t in r.turns] == [
        ("user", "hi ~1 [INST]"), ("assistant", "hello</s>"), ("user", "")
    ]
    assert (r.learned, r.n_turns, r.valid) == ("hello</s>", 3, True)


def test_turn_order(spark):
    orders = {
        "su": True, "sua": True, "ua": True, "uaua": True, "uau": True,
        "s": False, "a": False, "uu": False, "uas": False, "ss": False, "uaa": False, "x": False,
    }
    names = {"s": "system", "u": "user", "a": "assistant", "x": None}
    data = [
        (i, k, names[c], c) for i, order in enumerate(orders) for k, c in enumerate(order)
    ]
    got = made(spark, data)
    assert [got[i].valid for i in range(len(orders))] == list(orders.values())


pieces = st.sampled_from(["</s>", "<s>", "[INST]", "[/INST]", "~", "~0", "~1", "<", "[", "a", "\n", "é"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(pieces, max_size=12).map("".join), min_size=20, max_size=40))
def test_any_text_comes_back(spark, texts):
    data = [(0, i, texts[-i - 1] if i % 3 == 0 else "assistant", t) for i, t in enumerate(texts)]
    r = made(spark, data)[0]
    assert [tuple(t) for t in r.turns] == [(role, text) for _, _, role, text in data]
    assert r.learned == "".join(text for _, _, role, text in data if role == "assistant")
    body = r.formatted
    assert body.count("</s>") == body.count("[INST]") == body.count("[/INST]") == len(texts)


def test_edges(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
    data = [(None, None, None, None), (2, 0, "user", "x"), (2, 0, "user", "x"), (3, 0, "user", "y" * 200_000)]
    got = made(spark, data)
    assert [tuple(t) for t in got[None].turns] == [("", "")]
    assert got[2].n_turns == 2 and got[3].turns[0].text == "y" * 200_000
    df = spark.createDataFrame([(1, 0, "user", "x", 5)], SCHEMA + ", formatted int")
    assert chat.format_chats(df).collect()[0].formatted == "[INST]user[/INST]x</s>"
