import random

import pytest
from pyspark.sql import functions as F

from tributary.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, turns string, segments int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def read(spark, rows):
    df = chat.format_conversations(rows_of(spark, rows))
    return {r.conv_id: r for r in df.select("*", chat.read_turns(df["formatted"]).alias("back"), chat.learnt_texts(df["segments"]).alias("learnt")).collect()}


NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n", "<|assistant|>\n", "\\", "\\\\l", "\\b[", "<", "", "a\\", "|>\n", "日<本", "x" * 5000, None]


def test_round_trip(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "<|x|>\n", "", None]), "".join(rng.choice(NASTY) or "" for _ in range(rng.randint(0, 4)))) for c in range(60) for t in range(rng.randint(1, 6))]
    got = read(spark, rows)
    for c in range(60):
        want = sorted((t, r or "", x) for k, t, r, x in rows if k == c)
        assert [(x.role, x.text) for x in got[c].back] == [(r, x) for _, r, x in want]
        assert got[c].learnt == [x for _, r, x in want if r == "assistant"]
        assert got[c].formatted == "".join(s.text for s in got[c].segments)


@pytest.mark.parametrize("roles,valid", [
    ("user assistant", True), ("system user assistant user", True), ("assistant user", False), ("user user", False),
    ("system assistant", False), ("user assistant tool tool assistant", True), ("user other", False), ("user system assistant", False),
])
def test_machine(spark, roles, valid):
    got = read(spark, [(1, i, r, "t") for i, r in enumerate(roles.split())])
    assert got[1].valid_order == valid


def test_loss_follows_the_machine(spark):
    """Answers to a tool are states of their own; only they are learnt, and a broken move goes on from the role's state."""
    own = chat.Template(learnt=("answer",), moves={"start": {"user": "user"}, "user": {"assistant": "assistant"}, "assistant": {"tool": "tool"}, "tool": {"assistant": "answer"}})
    roles = ["user", "assistant", "tool", "assistant", "user", "tool", "assistant", "odd", "assistant"]
    df = chat.format_conversations(rows_of(spark, [(1, i, r, f"t{i}") for i, r in enumerate(roles)]), template=own)
    states = df.select("valid_order", chat.learnt_texts(df["segments"]).alias("learnt")).first()
    assert states.learnt == ["t3", "t6"] and not states.valid_order
    path = spark.createDataFrame([(roles,)], "roles array<string>").select(chat.run_machine(F.col("roles"), own).alias("p")).first().p
    assert [(x.state, x.valid) for x in path] == [
        ("user", True), ("assistant", True), ("tool", True), ("answer", True), ("user", False), ("tool", False), ("answer", True), ("", False), ("assistant", False),
    ]


def test_query_runs_the_machine(spark):
    from tributary.llm import queries

    from .conftest import FOLDER

    plan = queries.JOBS["op7_chat_formatting"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") >= 1


def test_long_conversation(spark):
    got = read(spark, [(1, i, ("user", "assistant")[i % 2], "x") for i in range(20_000)])
    assert got[1].valid_order and len(got[1].learnt) == 10_000


def test_no_marker_survives_in_texts(spark):
    got = read(spark, [(1, 0, "user", "<|end|>\n<s></s>[INST]<<SYS>>")])
    assert not any(m in got[1].segments[1].text for m in ("<", "["))


def test_edges(spark):
    got = read(spark, [(1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (None, 1, "user", "a")])
    assert [x.text for x in got[1].back] == ["first", "", ""] and got[1].n_turns == 3 and not got[1].valid_order
    assert got[None].n_turns == 1
    assert read(spark, []) == {}


def test_query(against_sql):
    against_sql("op7_chat_formatting")
