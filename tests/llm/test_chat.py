"""Chat windows: round trips, budgets, masks, and the SQL twin."""

import hashlib
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from wordbond.llm import chat, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, _conv string, parts string, _first int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA)


def odd_conversations():
    draw, rows = random.Random(2), []
    nasty = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s> [\\INST]", "a </s", "> b", "", None, " ", "x  [/INST] ",
             "\n\n", "[INST][INST]", "\\", "é🙂 </s>é", "[/INST", "INST]", "long word " * 400]
    for conv in range(40):
        if conv % 3 == 0:
            rows.append((conv, 0, "system", draw.choice(nasty)))
        for turn in range(1, draw.randrange(2, 30)):
            rows.append((conv, turn, draw.choice(["user", "assistant", "tool\n\\n", None, "system"]), draw.choice(nasty)))
    rows += [(None, 1, "user", "hi"), (None, 2, "assistant", "there"), (None, None, "user", "first")]
    rows += [(100, 1, "user", "tie"), (100, 1, "assistant", "tie"), (100, 1, "assistant", "tie"), (100, 5, "user", "end")]
    rows += [(101, turn, "assistant", f"answer {turn}") for turn in range(700)]
    return rows


def expected(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv, turns in by_conv.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        learnt = "".join(text for _, _, role, text in turns if role == "assistant")
        found[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt),
                       hashlib.sha256(learnt.encode()).hexdigest())
    return found


@pytest.mark.parametrize("budget, history, turns", [(40, 10, 2), (512, 128, 2), (60, 0, 0), (30, 29, 5)])
def test_round_trip(spark, workspace, budget, history, turns, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 16)
    rows = odd_conversations()
    made = workspace.store(chat.windows(table(spark, rows), workspace, budget, history, turns), "made")
    found = {r.conv_id: tuple(r)[1:5] for r in chat.digests(made).collect()}
    want = expected(rows)
    assert found.keys() == want.keys()
    for conv in want:
        assert found[conv] == want[conv], conv


def test_windows_keep_budget_system_turn_and_history(spark, workspace):
    rows = [(1, 0, "system", "be brief")]
    rows += [(1, t, "assistant" if t % 2 == 0 else "user", f"word{t} " * (t % 9 + 1)) for t in range(1, 60)]
    made = chat.windows(table(spark, rows), workspace, budget=50, history=16, history_turns=2)
    windows = made.select("first_turn", "n_repeated", "loss", "text", chat.parse_turns(F.col("text")).alias("turns"))
    seen = []
    for w in sorted(windows.collect(), key=lambda w: w.first_turn):
        assert w.turns[0].role == "system" and w.text.startswith("<s>[INST] system\nbe brief [/INST]")
        assert sum(len(t.text.split()) + 1 for t in w.turns) <= 50
        again = w.turns[:w.n_repeated]
        assert len(again) <= 3 and [t.text for t in again[1:]] == [t.text for t in seen[len(seen) - len(again) + 1:]]
        new = w.turns[w.n_repeated:]
        learnt = [w.text[s.start:s.start + s.length] for s in w.loss]
        assert learnt == [t.text for t in new if t.role == "assistant"]
        seen += new
    assert [t.text for t in seen] == [r[3] for r in rows]
    assert any(w.n_repeated > 1 for w in windows.collect())


def test_escaping_is_reversible(spark):
    draw = random.Random(1)
    texts = ["".join(draw.choice(["<", "s>", "/", "\\", "[", "INST]", "x", "</s>", "[/INST]"]) for _ in range(9))
             for _ in range(500)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escape(F.col("t")).alias("e")).select("t", "e", chat.unescape(F.col("e")).alias("u"))
    for row in frame.collect():
        assert row.u == row.t
        assert not any(mark in row.e for mark in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_empty_table(spark, workspace):
    assert chat.digests(chat.windows(table(spark, []), workspace)).collect() == []


def test_history_must_fit(spark, workspace):
    with pytest.raises(ValueError, match="budget"):
        chat.windows(table(spark, []), workspace, budget=10, history=10)


def test_query_equals_sql(spark, plan_of):
    found = queries.op9_chat_windows(spark, SF)
    assert "Python" not in plan_of(found) and "Arrow" not in plan_of(found)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    cursor = duck.execute(queries.SQL["op9_chat_windows"])
    names = [c[0] for c in cursor.description]
    rows = {r[names.index("conv_id")]: dict(zip(names, r)) for r in cursor.fetchall()}
    ours = {r.conv_id: r.asDict() for r in found.collect()}
    assert ours == rows
    assert ours[-7]["loss_chars"] == len("</s>[INST] ok [/INST]")
