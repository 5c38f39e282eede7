"""Conversation prefix trie against a brute-force trie; balanced parentheses against plain scans."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm.conv_trie import Parentheses, TrieParams, prefix_trie, shared_turns

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((t is not None, t or 0, digest, (role, text)))
    convs = {c: [x[3] for x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    nodes, below = {}, {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    for p in nodes:
        if p:
            below.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(nodes, key=len, reverse=True):
        members, children = nodes[p], below.get(p, [])
        leaves[p] = sum(leaves[k] for k in children) if children else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = sum(saved[k] for k in children) + (len(members) - 1) * words
        ends = ",".join(map(str, sorted(c for c in members if len(rebuilt[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children), leaves[p],
                    saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, params=TrieParams()):
    return sorted(map(tuple, prefix_trie(df, params).collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=300), st.sampled_from([2, 3, 64]))
def test_parentheses_delimit_subtrees(steps, block):
    depth = [0]
    for s in steps:
        depth.append(min(s, depth[-1] + 1))
    tree = Parentheses(np.array(depth), block)
    own = np.arange(len(depth)) + 1
    for v, d in enumerate(depth):
        end = next((k for k in range(v + 1, len(depth)) if depth[k] <= d), len(depth))
        assert tree.size[v] == end - v and tree.sums(own)[v] == own[v:end].sum()
        assert tree.leaves()[v] == sum(k + 1 == len(depth) or depth[k + 1] <= depth[k] for k in range(v, end))


def test_shared_turns():
    a, b, c = "a" * 32, "b" * 32, "a" * 31 + "b"
    assert [shared_turns(*x) for x in ((a, a), (a + b, a), (a + b, a + c), ("", a), (c, a), (a * 3, a * 2 + b))] == [1, 1, 1, 0, 0, 2]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(c - 30, rng.choice([None, t, t, t]), rng.choice(["user", "assistant", None]), rng.choice(["x  y\n", "z", None, "é"]))
            for c in range(rng.choice([70, 300])) for t in range(rng.choice([1, 2, 4, 8]))]
    rows += [(None, 1, "user", "none"), (None, None, None, None)]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("z") for c in ("chain", "words", "id", "shard", "h")})
    assert found(df) == brute(rows)


def test_copies_long_chains_and_a_hot_first_turn(spark):
    rows = [(c, t, "user", ["hello there", f"own {c % 7}", "bye"][t]) for c in range(200, 900) for t in range(3)]
    rows += [(2000 + c, t, "user", "same") for c in range(3) for t in range(1200 + c)]
    rows += [(3000 + c, t, "user", "same" if t < 1100 else f"{t % 3}") for c in range(4) for t in range(1100 + c)]
    assert found(spark.createDataFrame(rows, TURNS)) == brute(rows)


def test_ids_in_chunks_and_spine_by_shuffle(spark):
    rows = [(c, t, "user", f"{t}") for c in range(400) for t in range(5)] + [(c, 5, "user", f"{c % 9}") for c in range(300)]
    assert found(spark.createDataFrame(rows, TURNS), TrieParams(chunk=20, broadcast_rows=0, block=2)) == brute(rows)


def test_turnless_and_empty(spark):
    one = spark.createDataFrame([(1, 1, "user", "gone")], TURNS)   # crc32("1") % 4 is 3; its base is absent
    assert found(one) == brute([(1, 1, "user", "gone")]) == [
        (1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]
    assert prefix_trie(one.limit(0)).count() == 0
