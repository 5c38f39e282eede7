"""Conversation repair against a search over all edits, on damaged rows of small tables."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm.conv_repair import RepairParams, damaged, repair, repaired

TURNS = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """(cost, audit, lines) of [(role, text, fault)]: least over all edits, states by what came last."""
    best = {"": (0, "", ())}

    def inserted(best):
        for _ in range(2):
            for last, (c, a, out) in list(best.items()):
                role = "assistant" if last == "u" else "user"
                new = (c + 3, a + "I", out + (role + ":",))
                best[role[0]] = min(best.get(role[0], new), new)
        return best
    best = inserted(best)
    for role, text, fault in rows:
        after = {}

        def offer(last, new):
            after[last] = min(after.get(last, new), new)
        for last, (c, a, out) in best.items():
            offer(last, (c + 4, a + "D", out))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                follows = "assistant" if last == "u" else "user"
                if role[:1] == follows[0] or role[:1] == "s" and last == "":
                    offer(role[:1], (c + extra, a + "K", out + (f"{role}:{text}",)))
                offer(follows[0], (c + 3 + extra, a + "R", out + (f"{follows}:{text}",)))
        best = inserted(after)
    return min(best[x] for x in ("", "a") if x in best)


def brute(rows):
    convs = {}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        own = convs.setdefault(c, [])
        if kind:
            role = "user" if kind == 4 else role
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own += [(t is not None, t or 0, digest, t, role, text)] * (1 + (kind == 3))
    out = []
    for c, own in convs.items():
        seen, faulty, own = set(), [], sorted(own, key=lambda r: r[:3])
        for *_, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faulty.append((role, text, "blank" if not last else "duplicate" if (role, text) in seen
                           else "truncated" if last[0] not in ".!?" else ""))
            seen.add((role, text))
        turns = {r[3] for r in own} - {None}
        kinds = [f for *_, f in faulty]
        cost, audit, lines = cheapest(faulty)
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *map(kinds.count, ("blank", "duplicate", "truncated")),
                    sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(faulty)),
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def code(role, fault):
    return 4 * ["blank", "duplicate", "truncated", ""].index(fault) + " sua".index(role)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(" sua"), st.sampled_from(["blank", "duplicate", "truncated", "", "", ""])), max_size=12),
       st.sampled_from([1, 2, 5, 4096]))
def test_repair_is_cheapest_and_least(rows, segment):
    got = repair(bytes(code(*r) for r in rows), RepairParams(segment=segment))
    assert got == cheapest([(r, "x", f) for r, f in rows])[:2]


def test_segments_do_not_change_a_long_audit():
    rng = random.Random(4)
    codes = bytes(code(rng.choice("suua a"), rng.choice(["", "", "truncated", "duplicate"])) for _ in range(3000))
    whole = repair(codes, RepairParams(segment=10_000))
    assert whole == repair(codes, RepairParams(segment=64)) and len(whole[1]) >= 3000
    assert set(whole[1]) <= set("DIKR")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_query_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = ["Fine.", "Yes!", "cut off", "a?", None, "", " \n", "Fine. \t", "日本。", "ends\x0b"]
    rows = [(c - 40, rng.choice([t, t, t, t + 7, None]), rng.choice(["user", "assistant", "system", "s", "", "Tool", None]), rng.choice(texts))
            for c in range(200) for t in range(rng.choice([1, 2, 5, 9]))]
    rows += [(None, 1, "user", "Fine."), (None, None, None, None)] + rows[:30]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("z") for c in ("copies", "digest", "code", "cost", "first")})
    got = sorted(map(tuple, repaired(df).collect()), key=str)
    assert got == brute(rows)


def test_long_conversations_and_repeated_rows(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"{rng.choice(['x', t])}.") for t in range(6000)]
    rows += [(2, 5, "user", "Same.")] * 3000 + [(3, -2 ** 63, "user", "a."), (3, 2 ** 63 - 1, "user", "b.")]
    got = {r["conv_id"]: tuple(r) for r in repaired(spark.createDataFrame(rows, TURNS)).collect()}
    want = {r[0]: r for r in brute(rows)}
    want[3] = (3, min(want[3][1], 2 ** 63 - 1), *want[3][2:])
    assert got == want


def test_dropped_conversations_and_empty_table(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(dropped, 0, "user", "Hi.")], TURNS)
    assert damaged(one).first()["copies"] == 0
    assert list(map(tuple, repaired(one).collect())) == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repaired(one.limit(0)).count() == 0
