"""Snapshot collapse against a comparison of all conversations."""

from __future__ import annotations

import random

from launchtide.llm.conversations import format_chats

SCHEMA = "conv_id bigint, turn bigint, role string, text string, p1 string, line int"


def brute_force(rows):
    turns = {}
    for k, (conv, turn, role, text, *_) in enumerate(rows):
        # A row without conv_id is a conversation of its own.
        turns.setdefault((conv, k if conv is None else None), []).append((turn is None, turn or 0, role, text))
    lists = {k: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for k, v in turns.items()}
    kept = {}
    for conv, own in lists.items():
        if any(len(o) > len(own) and o[: len(own)] == own for o in lists.values()):
            continue
        kept.setdefault(tuple(own), []).append(conv[0])
    return sorted(
        (
            (
                min((c for c in convs if c is not None), default=None),
                len(own),
                len(convs),
                "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in own),
            )
            for own, convs in kept.items()
        ),
        key=str,
    )


def check(spark, rows):
    made = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = format_chats(made).collect()
    assert sorted(((r.conv_id, r.n_turns, r.n_copies, r.text) for r in found), key=str) == brute_force(rows)
    assert all(r.n_chars == len(r.text) for r in found)
    return found


def test_snapshots(spark):
    rng = random.Random(2)
    rows = []
    for k in range(60):
        whole = [(["user", "assistant"][i % 2], rng.choice(["hi", "yes", "no", "é\n"])) for i in range(rng.randrange(1, 6))]
        for j, n in enumerate(range(1, len(whole) + 1)):
            if rng.random() < 0.6:
                shift = rng.randrange(3)
                rows += [(k * 10 + j, shift + i, r, t, "x", 1) for i, (r, t) in enumerate(whole[:n])]
    assert check(spark, rows)


def test_edges(spark):
    rows = [
        (1, 0, "user", "a", "x", 1),
        (1, 1, None, "b", "x", 1),
        (2, 0, "user", "a", "x", 1),
        (3, 0, "user", None, "x", 1),
        (4, 0, "user", "", "x", 1),
        (5, None, "user", "late", "x", 1),
        (5, 3, "user", "soon", "x", 1),
        (6, 0, "user", "a", "x", 1),
        (6, 1, "", "b", "x", 1),
        (None, 0, "user", "a", "x", 1),
        (None, 1, None, "b", "x", 1),
        (7, 0, "user", "long " * 50_000, "x", 1),
        (8, 0, "user", "same", "x", 1),
        (8, 0, "user", "same", "x", 1),
    ]
    found = {r.conv_id: r for r in check(spark, rows)}
    assert set(found) == {None, 1, 3, 4, 5, 6, 7, 8} and found[1].n_copies == 1
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_without_conv_id(spark):
    """Half of all rows: each is a conversation, and equal ones are one row a task."""
    rows = [(None, k, "user", f"lone {k % 3}", "x", 1) for k in range(300)] + [(None, 0, None, None, "x", 1)]
    rows += [(k // 2, k % 2, "user", f"lone {k % 4}" if k < 200 else "lone 1", "x", 1) for k in range(300)]
    found = check(spark, rows)
    # The others begin longer ones.
    assert [(r.n_turns, r.text) for r in found if r.conv_id is None] == [(1, "<|im_start|>\n<|im_end|>\n")]
