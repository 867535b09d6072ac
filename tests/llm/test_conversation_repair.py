"""Cheapest repairs against a uniform-cost search over whole conversations."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib

import pytest

from tierline.llm import conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string, rank int, audit string, what string"
BLANKS = "\t\n\x0b\x0c\r "
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """(cost, audit, lines) of ``rows`` (role, text, fault): paths leave the queue by cost, then by audit."""
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, place, state, lines = heapq.heappop(queue)
        if place == len(rows) and state in ("", "a"):
            return cost, audit, lines
        if (place, state) in seen:
            continue
        seen.add((place, state))
        want = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[want]
        heapq.heappush(queue, (cost + 2, audit + "I", place, want, (*lines, f"{name}:")))
        if place < len(rows):
            role, text, fault = rows[place]
            heapq.heappush(queue, (cost + 3, audit + "D", place + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                more = cost + (fault == "truncated")
                heapq.heappush(queue, (more + 2, audit + "R", place + 1, want, (*lines, f"{name}:{text}")))
                if (state, role[:1]) in STEPS:
                    heapq.heappush(queue, (more, audit + "K", place + 1, STEPS[state, role[:1]], (*lines, f"{role}:{text}")))


def expected(conversations):
    left = {c[0]: [] for c in conversations}
    for conv, turn, role, text in conversations:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        left[conv] += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = []
    for conv, rows in left.items():
        def digest(role, text, conv=conv):
            told = f"{'' if conv is None else conv}:{len(role.encode())}:{role}{text}"
            return hashlib.sha256(told.encode()).hexdigest()

        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[1], r[2])))
        judged, seen = [], set()
        for _, role, text in rows:
            bare = text.rstrip(BLANKS)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        cost, audit, lines = cheapest(judged)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = [sum(f == name for _, _, f in judged) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        out.append((conv, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, conversations):
    table = spark.createDataFrame([(*c, 1, "x", "y") for c in conversations], SCHEMA).repartition(3)
    return sorted(map(tuple, cr.repair(table, cr.damaged(table)).collect()), key=repr)


def invented(seed, conversations, longest):
    rng = random.Random(seed)
    out = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "usher", "", None])
            if rng.random() < 0.6:
                role = ("user", "assistant")[turn % 2]
            text = rng.choice(["Yes.", "no", "Why?\n", " \t", "", None, "a.b", f"text {turn}.", f"t {turn}", "x:y\n.", "\u00a0", "é!"])
            out.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return out


ODD = [
    (None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (-1, 5, "system", "S."), (-1, 7, "user", "q " * 300_000 + "?"),
    (-1, 9, "assistant", "A." * 100_000), (-2, 2**40, "user", "far."), (-2, -(2**40), "assistant", "near."),
    *[(-3, 4, "user", "same.") for _ in range(150)], *[(-4, None, "assistant", f"{i}.") for i in range(130)],
]


def test_small_conversations(spark):
    rows = [*invented(1, 250, 9), *ODD[:8]]
    rows = list(dict.fromkeys(rows))
    assert found(spark, rows) == expected(rows)


def test_conversations_of_many_segments(spark):
    rows = [*invented(2, 12, 4 * cr.SEGMENT), *[(100 + i, r[1], r[2], r[3]) for i in range(2) for r in invented(3 + i, 1, 900)], *ODD]
    assert found(spark, rows) == expected(rows)


def test_given_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    assert sorted(map(tuple, cr.repair(table, cr.damaged(table)).collect()), key=repr) == expected(rows)


def test_no_conversations(spark):
    assert found(spark, []) == []


@pytest.mark.parametrize("seed", range(4))
def test_search_finds_the_cheapest_and_least(seed):
    rng = random.Random(seed)
    for _ in range(300):
        n = rng.randint(0, 12)
        roles, faults = "".join(rng.choices("suax", (1, 4, 4, 1), k=n)), "".join(rng.choices(".tbd", (6, 2, 1, 1), k=n))
        names = {"b": "blank", "d": "duplicate", "t": "truncated", ".": ""}
        want = cheapest([(r, "", names[f]) for r, f in zip(roles, faults)])
        assert cr.cheapest_edits(roles, faults) == want[:2], (roles, faults)


def test_the_bound_is_never_above_the_cost():
    rng = random.Random(9)
    for _ in range(500):
        n = rng.randint(0, 10)
        roles, faults = "".join(rng.choices("suax", k=n)), "".join(rng.choices("..tbd", k=n))
        assert cr._still_to_pay(roles, faults)[0][0] <= cr.cheapest_edits(roles, faults)[0]
