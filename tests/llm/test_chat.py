import random

import pytest

from lexmill.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, position int, conv string, prefix string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "b") for r in rows], SCHEMA)


def none_last(x):
    return (x is None, x if x is not None else "")


def plain(rows, per_part=256):
    chats = {}
    for c, turn, role, text in rows:
        chats.setdefault(c, []).append((turn is None, turn or 0, none_last(role), none_last(text), role, text))
    chats = {c: [x[4:] for x in sorted(v, key=lambda x: x[:4])] for c, v in chats.items()}
    out = []
    for c, turns in chats.items():
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns for o in chats.values())
        first = min((o for o in chats if chats[o] == turns), key=lambda o: (o is None, o or 0))
        if longer or first != c:
            continue
        for at in range(0, len(turns), per_part):
            part = turns[at : at + per_part]
            text = "".join(f"<|im_start|>{r if r is not None else 'user'}\n{t or ''}<|im_end|>\n" for r, t in part)
            out.append((c, at // per_part, len(part), text))
    return sorted(out, key=repr)


def rows_for(seed, n=60):
    r = random.Random(seed)
    turns = [("user", "hi"), ("assistant", "hello"), ("user", "more"), (None, "x"), ("system", None), ("user", ""), ("assistant", "ß")]
    rows = []
    for c in range(n):
        for t in range(r.randint(1, 5)):
            role, text = r.choice(turns[: r.choice([2, 3, 7])])
            rows.append((c, t, role, text))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,limits", [(0, {}), (1, {"max_rows": 2}), (2, {"max_rows": 1})])
def test_against_plain(spark, seed, limits):
    rows = rows_for(seed)
    got = chat.format_chats(table(spark, rows), turns_per_part=3, **limits).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, 3)


def test_edges(spark):
    rows = [(1, 0, "user", "a"), (1, None, "user", "b"), (2, 0, "user", "a"), (None, 0, "user", "a"), (None, 1, "user", "z"), (3, 0, None, None),
            (4, 0, "user", "x" * 300_000), (5, 0, "user", "a"), (5, 0, "user", "a"), (6, 2, "user", "a"), (6, 2, "assistant", "a"), (7, 5, "user", "a")]
    got = chat.format_chats(table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


@pytest.mark.parametrize("limits", [{}, {"max_rows": 100}])
def test_one_conversation_holds_most_turns(spark, limits):
    rows = [(9, t, "user" if t % 2 else "assistant", f"t{t % 5}") for t in range(1500)]
    rows += [(10 + c, t, "user" if t % 2 else "assistant", f"t{t % 5}") for c in range(40) for t in range(c + 1)]
    rows += [(100 + c, 0, "system", "shared first turn") for c in range(200)] + [(300 + c, 1, "user", f"q{c % 7}") for c in range(50)]
    got = chat.format_chats(table(spark, rows), **limits).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_empty_table(spark):
    assert chat.format_chats(table(spark, [])).count() == 0


def test_native(spark):
    plan = chat.format_chats(table(spark, rows_for(3, 5)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
