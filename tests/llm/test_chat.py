from __future__ import annotations

import hashlib
import itertools
import random

from pyspark.sql import functions as F

from ledgerloom.llm import chat

ROWS = "conv_id long, turn long, role string, text string, segments int"
PARTS = ["<turn>", "</turn>", "<next/>", "<says/>", "\\", "<", "turn>", "/turn>", "\\<", "x é", "\n", "$1"]


def table():
    draw = random.Random(4)
    rows = []
    for conv in range(60):
        for turn in range(draw.randint(1, 9)):
            text = "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 7)))
            rows.append((conv, turn // 2 if conv % 5 == 0 else turn, draw.choice(["user", "assistant", "system", "a<says/>\\"]), text, 1))
    return rows + [(None, None, None, None, 1), (None, 1, "user", None, 1), (99, 1, "assistant", "same", 1), (99, 1, "assistant", "same", 1)]


def key(x):
    return (x is not None, x)


def test_digests_are_those_of_the_rows(spark):
    rows = table()
    got = chat.digests(chat.format_conversations(spark.createDataFrame(rows, ROWS).repartition(5))).collect()
    want = {}
    ordered = sorted(rows, key=lambda r: (key(r[0]), key(r[1]), r[2] or "", r[3] or ""))
    for conv, own in itertools.groupby(ordered, key=lambda r: r[0]):
        turns = [(r[2] or "", r[3] or "") for r in own]
        trained = "".join(t for role, t in turns if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(trained), sha(trained))
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want


def test_same_roles_share_a_block_and_segments_are_the_text(spark):
    rows = [(1, 1, "user", "a", 1), (1, 2, "user", "b</turn>", 1), (1, 3, "assistant", "c", 1)]
    got = chat.format_conversations(spark.createDataFrame(rows, ROWS)).first()
    assert got.formatted == "<turn>user<says/>a<next/>b<\\/turn></turn><turn>assistant<says/>c</turn>"
    assert "".join(s.text for s in got.segments) == got.formatted
    assert [s.text for s in got.segments if s.loss] == ["c"]


def test_escapes_are_undone(spark):
    texts = ["".join(p) for p in itertools.product(PARTS[:10], repeat=3)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for row in df.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert row.u == row.t
        assert not any(mark in row.e for mark in (chat.OPEN, chat.SAYS, chat.NEXT, chat.CLOSE))


def test_no_rows(spark):
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], ROWS))).collect() == []
