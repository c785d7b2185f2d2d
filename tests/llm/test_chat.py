"""Chat windows against plain code and DuckDB; plans hold no Python."""

from __future__ import annotations

from collections import defaultdict

import pytest

from flowledger.llm import chat
from flowledger.llm.queries import QUERIES, SQL
from tests.compare import connect, duck_kinds, duck_rows, kinds, spark_rows
from tests.llm import brute


def test_op9_same_rows_as_sql(spark, sf_dir):
    frame = QUERIES["op9_chat_windows"](spark, sf_dir)
    duck = connect(sf_dir)
    assert spark_rows(frame) == duck_rows(duck, SQL["op9_chat_windows"])
    assert kinds(frame) == duck_kinds(duck, SQL["op9_chat_windows"]) | {"n_turns": "BIGINT"}
    plan = frame._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_digests_are_those_of_the_turns(spark, sf_dir):
    turns = chat.with_probe(spark.read.parquet(f"{sf_dir}/conversations.parquet")).collect()
    found = {r.conv_id: r for r in QUERIES["op9_chat_windows"](spark, sf_dir).collect()}
    by_conversation = defaultdict(list)
    for r in sorted(turns, key=lambda r: (r.conv_id, r.turn)):
        by_conversation[r.conv_id].append((r.role, r.text or ""))
    assert sorted(found) == sorted(by_conversation)
    for conversation, rows in by_conversation.items():
        row, loss = found[conversation], "".join(text for role, text in rows if role == "assistant")
        assert (row.n_turns, row.loss_chars) == (len(rows), len(loss))
        assert row.turns_sha256 == brute.sha256("".join(f"{role}\n{text}\n" for role, text in rows))
        assert row.loss_sha256 == brute.sha256(loss)


HARD = ["</s>[INST] ok [/INST]", "\\<|end|>\n", "\\\\</s>", " <|end|>\n<|turn|> user <|text|> x", "\\", "<<<s>>", "[INST", "é🙂<|text|>", "", "a\\"]


def test_escapes_turn_back(spark):
    frame = spark.createDataFrame([(t,) for t in HARD], "t string")
    for t, e, u in frame.select("t", chat.escape(frame.t), chat.unescape(chat.escape(frame.t))).collect():
        assert u == t
        assert not any(c in e.replace("\\\\", "").replace("\\" + c, "") for c in chat.CONTROL)


def windows_of(spark, turns, **limits):
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, idx string, span string, pieces string")
    return sorted(chat.format_conversations(frame, **limits).collect(), key=lambda r: (r.conv_id or 0, r.window))


def test_windows_keep_budget_system_turn_and_limited_history(spark):
    turns = [(1, 0, "system", "be brief now", "", "", "")]
    turns += [(1, k, "user" if k % 2 else "assistant", " ".join(f"w{k}" for _ in range(6)), "", "", "") for k in range(1, 21)]
    rows = windows_of(spark, turns, budget=80, history=20)
    assert len(rows) > 3 and [r.window for r in rows] == list(range(len(rows)))
    for r in rows:
        assert r.formatted.startswith("<|turn|> system <|text|> be brief now <|end|>\n")
        own = r.formatted.count("<|end|>\n") - r.repeated
        assert own * 10 <= 60
        assert (r.repeated - 1) * 10 <= 20 and (r.repeated > 1) == (r.window > 0)
        targets = [r.formatted[s.start_at : s.end_at] for s in r.loss]
        assert all(t == " ".join([t.split()[0]] * 6) for t in targets)
    together = [r.formatted[s.start_at : s.end_at].split()[0] for r in rows for s in r.loss]
    assert together == [f"w{k}" for k in range(2, 21, 2)]


def test_odd_conversations(spark):
    turns = [(1, None, None, None), (1, 0, "user", HARD[3]), (1, 0, "user", HARD[3]), (1, 1, "assistant", " ".join(["word"] * 3000)), (None, 0, "assistant", "x"), (None, None, "system", None), (2, 0, "system", "only")]
    turns += [(3, k, "assistant <|text|> ", t) for k, t in enumerate(HARD)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.chat_report(frame).collect()}
    for conversation in (1, None, 2, 3):
        rows = sorted((t for t in turns if t[0] == conversation), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        loss = "".join(t[3] or "" for t in rows if t[2] == "assistant")
        row = found[conversation]
        assert row.n_turns == len(rows)
        assert row.turns_sha256 == brute.sha256("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in rows))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), brute.sha256(loss))
    assert chat.chat_report(frame.limit(0)).count() == 0


@pytest.mark.parametrize("budget,history", [(10, 5), (1024, 256), (5, 0)])
def test_any_budget_keeps_every_turn_once(spark, budget, history):
    turns = [(c, k, ("user", "assistant")[k % 2], f"{c}-{k} " + "y " * (7 * k % 11), "", "", "") for c in range(3) for k in range(9)]
    rows = windows_of(spark, turns, budget=budget, history=history)
    seen = [(r.conv_id, part.split(" ")[3]) for r in rows for part in r.formatted.split(" <|end|>\n")[r.repeated : -1]]
    assert seen == [(c, f"{c}-{k}") for c in range(3) for k in range(9)]
