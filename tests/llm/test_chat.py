"""Chat formatting against SQL, round trips and the state machine."""

import hashlib
import random

import pytest
from oracle import compare

from ledgerspark.llm import chat
from ledgerspark.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = ["\\", "\\0", "</turn>", "### ", "</turn>\n", ": ", "\\1\\2", "</tu", "rn>", "###", " ", "\n", "", "é𝄞"]


def test_query_matches_sql(spark):
    assert compare(spark, "/root/testdata/sf0.01", "op9_chat_formatting") is None


def test_probe_conversation(spark):
    probe = QUERIES["op9_chat_formatting"](spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    said = "\\### Assistant: </turn> ok"
    assert probe.n_turns == 2 and probe.loss_chars == len(said)
    assert probe.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert probe.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_round_trip_of_hard_texts(spark, seed):
    rng = random.Random(seed)
    made = lambda: "".join(rng.choice(HARD) for _ in range(rng.randrange(6)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", made()]), made()) for c in range(60)
            for t in range(rng.randrange(1, 6))]
    formatted = chat.format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(4))
    back = {r.conv_id: r.turns for r in chat.read_back(formatted).collect()}
    for r in formatted.collect():
        want = sorted((t, role, text) for c, t, role, text in rows if c == r.conv_id)
        assert [(x.role, x.text) for x in back[r.conv_id]] == [w[1:] for w in want]
        assert "".join(s.text for s in r.segments) == r.formatted
        assert [s.loss for s in r.segments[1::3]] == [w[1] == "assistant" for w in want]
        assert not any(s.loss for s in r.segments[0::3] + r.segments[2::3])


def test_state_machine(spark):
    orders = {1: "system user assistant", 2: "user assistant user", 3: "assistant user", 4: "user user",
              5: "user system", 6: "", 7: "user tool assistant"}
    rows = [(c, t, role, "x") for c, roles in orders.items() for t, role in enumerate(roles.split(" "))]
    got = {r.conv_id: (r.state, r.valid) for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    bad = ("invalid", False)
    assert got == {1: ("assistant", True), 2: ("user", True), 3: bad, 4: bad, 5: bad, 6: bad, 7: bad}


def test_another_template(spark):
    tools = chat.Template(open="<|", after_role="|>", close="<|end|>", escapes=(("~", "~0"), ("<|", "~1")),
                          role_escapes=(("|>", "~2"),), trained=("assistant", "tool"),
                          moves={"start": ("user",), "user": ("tool",), "tool": ("assistant",)})
    rows = [(1, 0, "user", "<|end|> ~"), (1, 1, "tool", "|>"), (1, 2, "assistant", "~1")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), tools)
    assert formatted.first().state == "assistant"
    assert [tuple(t) for t in chat.read_back(formatted, tools).first().turns] == [
        ("user", "<|end|> ~", False), ("tool", "|>", True), ("assistant", "~1", True)]


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a"), (None, 1, None, None), (1, None, "assistant", "b"), (1, None, "assistant", "b"),
            (1, 0, "user", "z" * 500_000), (2, 0, "", "")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", formatted string, turns int")
    got = {r.conv_id: [(t.role, len(t.text), t.loss) for t in r.turns]
           for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got == {None: [("user", 1, False), ("", 0, False)], 2: [("", 0, False)],
                   1: [("assistant", 1, True), ("assistant", 1, True), ("user", 500_000, False)]}
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_trained_text_is_what_the_flags_mark(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "\\a </turn>"), (1, 2, "user", "### "), (1, 3, "assistant", "\\0b")]
    got = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).select(chat.trained_text().alias("t")).first()
    assert got.t == "\\a </turn>\\0b"


def test_very_many_turns(spark):
    rows = spark.range(20_001).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
                                          "concat('turn ', id) AS text")
    r = chat.read_back(chat.format_conversations(rows)).select("state", "valid", chat.trained_text().alias("t"), "turns").first()
    assert r.valid and r.state == "user" and [t.text for t in r.turns] == [f"turn {i}" for i in range(20_001)]
    assert r.t == "".join(f"turn {i}" for i in range(1, 20_001, 2))
