"""Prefix trie of conversations as balanced parentheses, one encoding a shard.

A turn is known by a digest of its role and text, a conversation by the chain of its
turns' digests. Distinct chains are dealt out by range, so each shard holds a
contiguous part of the trie in depth-first order. There the trie is written as
parentheses, an opening one where a node is met and a closing one where its subtree
ends. Blocks of the running excess with their minimum and maximum, and a tree of
such blocks above them, find every node's closing parenthesis; that delimits its
subtree. The rank of "()" pairs inside counts leaves, and differences of cumulative
arrays in depth-first order give members and saved tokens.

A chain of nodes is shared by two shards where the last chain of one and the first
of the next begin alike; this spine is all that is incomplete in a shard. Spine
nodes are merged by key (their counts add up), and encoded as parentheses once more
to add what the spine itself holds. The merged spine has at most (shards x longest
shared beginning) nodes and no more than that passes through one task.

Members that end at a node are hashed in order of their ids: sorted ranges join ids
to texts of bounded length, one task a node feeds these to the hash as they come.

Turns are ordered by turn (null first), then by digest. Texts are never gathered: a
conversation travels as 32 characters and one number a turn.

Defined results: null role or text counts as empty; rows without conv_id belong to
no conversation and are left out; rows that are repeated are turns of their own; an
empty table gives no nodes. Remainders of negative ids are those of SQL (towards
zero). Only conv_id, turn, role and text are read. A sum of saved tokens beyond 64
bits is not foreseen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import n_partitions, stage

DIGEST = 32   # characters of a turn's digest
NODES = ("key string, depth long, conv_id long, parent_key string, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string")
NO_ENDS = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class TrieParams:
    base: int = 20                 # conversations of one base share its beginning
    heads: int = 4                 # that is crc32(conv_id) mod heads turns
    block: int = 64                # parentheses of an excess block
    chunk: int = 1 << 16           # characters of joined ids
    broadcast_rows: int = 100_000  # spine nodes sent to every task; beyond, they are joined by shuffle


class Parentheses:
    """A tree given by its nodes' depths in depth-first order, as balanced parentheses."""

    def __init__(self, depth: np.ndarray, block: int = 64):
        n = len(depth)
        self.opening = 2 * np.arange(n) - depth   # v opened before, v - depth of them closed
        bits = np.zeros(2 * n, np.int8)
        bits[self.opening] = 1
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        self.pairs = np.concatenate([[0], np.cumsum((bits[:-1] == 1) & (bits[1:] == 0))])
        # Minimum and maximum of the excess by block, then of two blocks each, up to one.
        self.block = block
        short = -len(self.excess) % block
        padded = np.concatenate([self.excess, np.full(short, self.excess[-1])]).reshape(-1, block)
        self.low, self.high = [padded.min(1)], [padded.max(1)]
        while len(self.low[-1]) > 1:
            for kept, of in ((self.low, np.minimum), (self.high, np.maximum)):
                level = kept[-1]
                if len(level) % 2:
                    level = np.append(level, level[-1])
                kept.append(of(level[::2], level[1::2]))
        self.closing = self.find_close()
        self.size = (self.closing - self.opening + 1) // 2

    def _within(self, start: np.ndarray, end: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First position from start to before end whose excess is the target; -1 if there is none."""
        found = np.full(len(start), -1)
        at, todo = start.copy(), np.flatnonzero(start < end)
        while len(todo):
            hit = self.excess[at[todo]] == target[todo]
            found[todo[hit]] = at[todo[hit]]
            todo = todo[~hit]
            at[todo] += 1
            todo = todo[at[todo] < end[todo]]
        return found

    def find_close(self) -> np.ndarray:
        """The closing parenthesis of every opening one: where the excess first falls below it."""
        target = self.excess[self.opening] - 1
        block, total = self.block, len(self.excess)
        at = self.opening // block
        closing = self._within(self.opening + 1, np.minimum((at + 1) * block, total), target)
        todo = np.flatnonzero(closing < 0)
        # Upwards: the next block, or block of blocks, whose range of excess holds the target.
        x, level = at[todo] + 1, np.full(len(todo), -1)
        for k in range(len(self.low)):
            low, high = self.low[k], self.high[k]
            for _ in range(2):
                new = np.flatnonzero((level < 0) & (x < len(low)))
                hit = new[(low[x[new]] <= target[todo[new]]) & (target[todo[new]] <= high[x[new]])]
                level[hit] = k
                on = (level < 0) & (x % 2 == 0)   # the right one of the two is still below the same parent
                x[on] += 1
            on = level < 0
            x[on] = (x[on] + 1) // 2
        # Downwards: the left half if it holds the target, else the right one.
        for k in range(len(self.low) - 1, 0, -1):
            on = np.flatnonzero(level >= k)
            x[on] *= 2
            right = (self.low[k - 1][x[on]] > target[todo[on]]) | (self.high[k - 1][x[on]] < target[todo[on]])
            x[on[right]] += 1
        closing[todo] = self._within(x * block, np.minimum((x + 1) * block, total), target[todo])
        return closing

    def leaves(self) -> np.ndarray:
        """Pairs "()" inside each node."""
        return self.pairs[self.closing] - self.pairs[self.opening]

    def sums(self, own: np.ndarray) -> np.ndarray:
        """Sum over each node's subtree."""
        total = np.concatenate([[0], np.cumsum(own)])
        first = np.arange(len(own))
        return total[first + self.size] - total[first]


def shared_turns(a: str, b: str) -> int:
    """How many turns two chains begin with alike."""
    n = min(len(a), len(b)) // DIGEST
    if not n or a[:DIGEST] != b[:DIGEST]:
        return 0
    x, y = (np.frombuffer(s[:n * DIGEST].encode(), f"S{DIGEST}") for s in (a, b))
    differ = x != y
    return int(differ.argmax()) if differ.any() else n


def chain_keys(chain: str, depth: int) -> list[str]:
    """Keys of the nodes of depths 0 to ``depth`` on a chain."""
    h = hashlib.md5()
    out = [h.hexdigest()]
    for d in range(depth):
        h.update(chain[d * DIGEST:(d + 1) * DIGEST].encode())
        out.append(h.copy().hexdigest())
    return out


def shard_nodes(chains: list[str], convs: list[int], counts: list[int], words: list[list[int]], ends: list[str],
                left: int, right: int, block: int) -> dict[str, list]:
    """Columns of NODES of one shard; sorted distinct chains, ``left`` and ``right`` turns of them on the spine."""
    depth, parent, last_words, ending = [0], [-1], [0], []
    stack = [0]   # nodes of the chain at hand by depth
    for k, chain in enumerate(chains):
        same = shared_turns(chains[k - 1], chain) if k else 0
        length, first = len(chain) // DIGEST, len(depth)
        del stack[same + 1:]
        parent += [stack[same], *range(first, first + length - same - 1)][:length - same]
        depth += range(same + 1, length + 1)
        last_words += words[k][same:length]
        stack += range(first, first + length - same)
        ending.append(stack[length])
    n = len(depth)
    tree = Parentheses(np.array(depth), block)
    spine = np.zeros(n, bool)
    spine[:left + 1] = True   # the first chain's nodes come first
    spine[stack[:right + 1]] = True
    parent_of, weight = np.array(parent), np.zeros(n, np.int64)
    weight[ending] = counts
    members = tree.sums(weight)
    smallest = np.full(n, np.iinfo(np.int64).max)
    smallest[ending] = convs
    by_depth = np.argsort(depth, kind="stable")
    bounds = np.searchsorted(np.array(depth)[by_depth], np.arange(max(depth) + 2))
    for d in range(max(depth), 0, -1):
        level = by_depth[bounds[d]:bounds[d + 1]]
        np.minimum.at(smallest, parent_of[level], smallest[level])
    saved = tree.sums(np.where(spine, 0, (members - 1) * np.array(last_words, np.int64)))
    # A spine node without children here has some elsewhere, or is counted when the spine is merged.
    bare = np.zeros(n, np.int64)
    bare[spine & (tree.size == 1)] = 1
    leaves = tree.leaves() - tree.sums(bare)
    children = np.bincount(parent_of[1:][~spine[1:]], minlength=n)
    key = [None] * n
    for chain, nodes in ((chains[0], range(left + 1)), (chains[-1], stack[:right + 1])):
        for v, name in zip(nodes, chain_keys(chain, len(nodes) - 1)):
            key[v] = name
    sha = [NO_ENDS] * n
    for v, s in zip(ending, ends):
        sha[v] = s
    smallest = smallest.tolist()
    return {"key": key, "depth": depth, "conv_id": smallest, "parent_key": [key[p] if p >= 0 else None for p in parent],
            "parent_conv_id": [smallest[p] if p >= 0 and key[p] is None else None for p in parent],
            "n_convs": members.tolist(), "n_children": children.tolist(), "n_leaves": leaves.tolist(),
            "saved_tokens": saved.tolist(), "words": last_words, "ends_sha256": sha}


def spine_nodes(rows: list[dict], block: int) -> list[dict]:
    """Merged spine nodes with what the spine itself holds added to the sums of the shards."""
    by_key = {r["key"]: i for i, r in enumerate(rows)}
    below: list[list[int]] = [[] for _ in rows]
    root = 0
    for i, r in enumerate(rows):
        if r["parent_key"] is None:
            root = i
        else:
            below[by_key[r["parent_key"]]].append(i)
    order, todo = [], [root]
    while todo:
        i = todo.pop()
        order.append(i)
        todo += below[i]
    rows, children = [rows[i] for i in order], [len(below[i]) for i in order]
    tree = Parentheses(np.array([r["depth"] for r in rows]), block)
    for r, c in zip(rows, children):
        r["n_children"] += c
    leaves = tree.sums(np.array([r["n_children"] == 0 for r in rows], np.int64))
    saved = tree.sums(np.array([(r["n_convs"] - 1) * r["words"] for r in rows], np.int64))
    smallest = {r["key"]: r["conv_id"] for r in rows}
    for r, x, y in zip(rows, leaves.tolist(), saved.tolist()):
        r["n_leaves"] += x
        r["saved_tokens"] += y
        r["parent_conv_id"] = smallest.get(r["parent_key"])
    return rows


def turn_digest(role, text):
    """A turn's identity: md5 over the length of its role, the role and the text."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def rebuilt_chains(conversations: DataFrame, params: TrieParams) -> DataFrame:
    """(conv_id, chain, words): every conversation with the beginning of its base conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        turn_digest(role, text).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words")).filter("conv_id IS NOT NULL")
    own = stage(turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "digest", "words"))).alias("turns")), "trie-turns")
    heads = own.filter(F.col("conv_id") % params.base == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, params.heads).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % params.heads).cast("int")
    whole = own.withColumn("h", h).join(
        heads, F.col("conv_id") - F.col("conv_id") % params.base == F.col("base"), "left").select(
        "conv_id", F.concat(F.coalesce(F.slice("head", 1, F.col("h")), F.slice("turns", 1, 0)),
                            F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))
    return whole.select("conv_id", F.array_join(F.transform("turns", lambda t: t["digest"]), "").alias("chain"),
                        F.transform("turns", lambda t: t["words"]).alias("words"))


def ended_hashes(members: DataFrame, params: TrieParams) -> DataFrame:
    """(id, ends_sha256) of (id, conv_id): the hash of each group's ids in order, joined by commas."""
    n, most = n_partitions(members.sparkSession), params.chunk

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, first, ids, size = None, 0, [], 0
        schema = pa.schema([("id", pa.string()), ("first", pa.int64()), ("ids", pa.string())])
        for b in batches:
            out = []
            for group, conv in zip(b["id"].to_pylist(), b["conv_id"].to_pylist()):
                if group != of or size > most:
                    if ids:
                        out.append({"id": of, "first": first, "ids": ",".join(ids)})
                    of, first, ids, size = group, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if ids:
            yield pa.RecordBatch.from_pylist([{"id": of, "first": first, "ids": ",".join(ids)}], schema)

    def hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, h = None, None
        schema = pa.schema([("id", pa.string()), ("ends_sha256", pa.string())])
        for b in batches:
            out = []
            for group, ids in zip(b["id"].to_pylist(), b["ids"]):
                if group != of:
                    if h:
                        out.append({"id": of, "ends_sha256": h.hexdigest()})
                    of, h = group, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.as_py().encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if h:
            yield pa.RecordBatch.from_pylist([{"id": of, "ends_sha256": h.hexdigest()}], schema)

    parts = (members.select("id", "conv_id").repartitionByRange(n, "id", "conv_id").sortWithinPartitions("id", "conv_id")
             .mapInArrow(join_ids, "id string, first long, ids string"))
    return (parts.repartition(n, "id").sortWithinPartitions("id", "first")
            .mapInArrow(hash_ids, "id string, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    n, block = n_partitions(conversations.sparkSession), params.block
    convs = stage(rebuilt_chains(conversations, params).withColumn("id", F.md5("chain")), "trie-chains")
    distinct = convs.groupBy("id").agg(F.first("chain").alias("chain"), F.first("words").alias("words"),
                                       F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    dealt = stage(distinct.join(ended_hashes(convs, params), "id").repartitionByRange(n, "chain")
                  .withColumn("shard", F.spark_partition_id()).drop("id"), "trie-shards")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                yield pa.RecordBatch.from_pylist([{
                    "shard": r["shard"], "left": shared_turns(r["before"] or "", r["lo"]),
                    "right": shared_turns(r["hi"], r["after"] or "")}], schema=pa.schema(
                        [("shard", pa.int32()), ("left", pa.int32()), ("right", pa.int32())]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes(rows: dict[str, list]) -> Iterator[pa.RecordBatch]:
            if rows:
                made = pa.table(shard_nodes(rows["chain"], rows["conv_id"], rows["n"], rows["words"], rows["ends_sha256"],
                                            rows["left"][0], rows["right"][0], block), schema=NODE_SCHEMA)
                yield from made.to_batches(max_chunksize=20_000)
        rows: dict[str, list] = {}
        for b in batches:
            shards = b["shard"].to_numpy(zero_copy_only=False)
            for part in np.split(np.arange(len(shards)), np.flatnonzero(np.diff(shards)) + 1):
                if len(part):
                    if rows and rows["shard"][-1] != shards[part[0]]:
                        yield from nodes(rows)
                        rows = {}
                    cut = b.slice(part[0], len(part))
                    for c in cut.schema.names:
                        rows.setdefault(c, []).extend(cut[c].to_pylist())
        yield from nodes(rows)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        if rows:
            yield from pa.Table.from_pylist(spine_nodes(rows, block), schema=NODE_SCHEMA).to_batches(max_chunksize=20_000)

    by_shard = Window.orderBy("shard")   # one row a shard
    borders = (dealt.groupBy("shard").agg(F.min("chain").alias("lo"), F.max("chain").alias("hi"))
               .select("shard", "lo", "hi", F.lag("hi").over(by_shard).alias("before"),
                       F.lead("lo").over(by_shard).alias("after"))
               .mapInArrow(shared, "shard int, left int, right int"))
    nodes = stage(dealt.join(borders, "shard").repartition(n, "shard").sortWithinPartitions("shard", "chain")
                  .mapInArrow(encode, NODES), "trie-nodes")
    spine = stage(nodes.filter("key IS NOT NULL").groupBy("key").agg(
        *[f(c).alias(c) for c, f in (
            ("depth", F.min), ("conv_id", F.min), ("parent_key", F.max), ("parent_conv_id", F.max), ("n_convs", F.sum),
            ("n_children", F.sum), ("n_leaves", F.sum), ("saved_tokens", F.sum), ("words", F.max),
            ("ends_sha256", lambda c: F.coalesce(F.max(F.when(F.col(c) != NO_ENDS, F.col(c))), F.lit(NO_ENDS))))])
        .repartition(1).mapInArrow(merge, NODES), "trie-spine")
    above = spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("spine_conv"))
    inner = nodes.filter("key IS NULL").drop("key")
    # The root is the parent of any number of nodes; it is one row.
    top = above.join(F.broadcast(spine.filter("depth = 0").select(F.col("key").alias("parent_key"))), "parent_key")
    deep = above if spine.count() > params.broadcast_rows else F.broadcast(above)
    rest = (inner.filter("depth > 1").join(deep, "parent_key", "left")
            .union(inner.filter("depth = 1").join(F.broadcast(top), "parent_key", "left")
                   .select("parent_key", *[c for c in inner.columns if c != "parent_key"], "spine_conv")))
    rest = rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "spine_conv"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return spine.select(out).union(rest.select(out))


NODE_SCHEMA = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in NODES.split(", ")])
