"""Conversation structure repair by a cost DP and prefix-doubling path ranking.

A repaired conversation's role initials read ``(s?(ua)+)?``. Its rows are kept (free),
given another role, deleted (a must for blank rows and duplicates) or preceded by an
inserted row without text; a truncated row that stays costs extra. The states are
(rows read, what came last), and a backward DP gives every state's least cost to the
end. Arcs that keep to it are optimal; a state's optimal arcs bear different edits.

Among the cheapest edits those whose initials (D, I, K, R) are ASCII-least are wanted.
Ranks find them: every state is ranked by the first edit of its least path, then, as
pointers double, by its least path's first 2, 4, 8 ... edits, until whole paths are
ranked. A state's rank is the pair of its own and of the one it points to. Following
the doubled pointers from the start gives the path.

Long conversations are cut into segments: the DP keeps the costs at segment ends
only, and the ranking goes through one segment after the other from the state in which
the last one ended. As edits at a state differ, the least path is the same.

Work is split in two, so that memory is bounded by one byte a row and a batch: rows
without texts (turn, digest, role initial) are sorted by conversation and give faults,
cost and audit; then the texts follow, sorted the same, behind their audit, and run
through the hash as they come. Duplicates are found by windows on the digest.

Defined results: null role or text is one space (as is a null in the key of the damage);
rows of a null conv_id are one conversation, returned under null; rows of one turn are
ordered by the digest of role and text, and equal rows lie side by side. Turns that are
too far apart for 64 bits give the largest gap there is. An empty table gives no rows.
Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.conv_trie import turn_digest
from tidemark.llm.shared import n_partitions, stage

BLANK, DUPLICATE, TRUNCATED, SOUND, DROPPED = range(5)
OTHER, SYSTEM, USER, ASSISTANT = range(4)          # role initials; also what came last, nothing being OTHER
EDITS = "DIKR"                                     # ASCII order
DELETE, INSERT, KEEP, REROLE = range(4)
SHORT, KNOWN = 64, 50_000                          # rows of conversations whose audits a task remembers, and how many
FAR = np.iinfo(np.int64).max // 4
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
SCHEMA = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"


@dataclass(frozen=True)
class RepairParams:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3
    segment: int = 4096   # rows ranked at once


def arcs_of_row(code: int, params: RepairParams) -> list[tuple[int, int, int, int]]:
    """(state, edit, next state, cost) of reading one row; its code is 4 * fault + initial."""
    fault, initial = divmod(code, 4)
    out = [(q, DELETE, q, params.delete) for q in range(4)]
    if fault not in (BLANK, DUPLICATE):
        extra = params.truncated if fault == TRUNCATED else 0
        for q in range(4):
            follows = ASSISTANT if q == USER else USER
            if initial == follows or initial == SYSTEM and q == OTHER:
                out.append((q, KEEP, initial, extra))
            out.append((q, REROLE, follows, extra + params.rerole))
    return out


class Costs:
    """Least costs to the end of each of the four states, backwards row by row."""

    def __init__(self, params: RepairParams):
        self.params = params
        self.arcs: dict[int, list] = {}

    def inserted(self, cost: list[int]) -> list[int]:
        """Costs where rows may be inserted first: a user row after anything but one, then an assistant row after it."""
        none, system, user, assistant = cost
        price = self.params.insert
        user = min(user, assistant + price)
        assistant = min(assistant, user + price)
        return [min(none, user + price), min(system, user + price), user, assistant]

    def before(self, code: int, after: list[int]) -> list[int]:
        """Costs in front of a row from those behind it."""
        out = [FAR] * 4
        for state, _, to, price in self.arcs.get(code) or self.arcs.setdefault(code, arcs_of_row(code, self.params)):
            if price + after[to] < out[state]:
                out[state] = price + after[to]
        return self.inserted(out)

    def at_end(self) -> list[int]:
        return self.inserted([0, FAR, FAR, 0])


def least_path(cost: np.ndarray, codes: bytes, start: int, params: RepairParams, last: bool) -> tuple[list[int], int]:
    """Edits of the least optimal path through a segment, and the state in which it leaves.

    ``cost[i, q]`` is the least cost to the end before row i of the segment. The path
    leaves at the first state behind its rows, or, in the last segment, where it ends.
    """
    n = len(codes)
    nodes = 4 * (n + 1)
    # Each state's optimal arc of the least edit; those behind the segment, or at the end, point to themselves.
    edit, to = np.full(nodes, -1), np.arange(nodes)
    flat = cost.reshape(-1)
    rows = np.frombuffer(codes, np.uint8)
    state = np.arange(nodes) % 4

    def offer(at: np.ndarray, what: int, target: np.ndarray, price: int) -> None:
        good = (flat[at] < FAR // 2) & (flat[at] == flat[target] + price) & ((edit[at] < 0) | (edit[at] > what))
        edit[at[good]], to[at[good]] = what, target[good]

    for code in np.unique(rows):
        places = np.flatnonzero(rows == code)
        for q, what, q2, price in arcs_of_row(int(code), params):
            offer(4 * places + q, what, 4 * (places + 1) + q2, price)
    within = np.arange(nodes if last else nodes - 4)
    follows = np.where(state[within] == USER, ASSISTANT, USER)
    offer(within, INSERT, within - state[within] + follows, params.insert)
    if last:
        done = np.array([nodes - 4 + OTHER, nodes - 4 + ASSISTANT])
        edit[done], to[done] = -1, done
    # Doubling: rank by the first 2^k edits from the ranks of the first 2^(k-1) and of those behind them.
    jumps, rank = [to], edit + 1
    while (jumps[-1] != jumps[-1][jumps[-1]]).any():
        pair = rank * (rank.max() + 1) + rank[jumps[-1]]
        rank = np.unique(pair, return_inverse=True)[1]
        jumps.append(jumps[-1][jumps[-1]])
    # The path's length by the doubled pointers, then its nodes: the first 2^k of them give the next as many.
    path = np.array([start])
    for jump in jumps:
        path = np.concatenate([path, jump[path]])
    edits = edit[path]
    end = int(np.argmax(edits < 0))   # the doubled pointers lead to a node that points to itself
    return edits[:end].tolist(), int(path[end]) % 4


def repair(codes: bytes, params: RepairParams = RepairParams()) -> tuple[int, str]:
    """Cost and audit of a conversation given by a byte a row: 4 * fault + role initial."""
    costs, step = Costs(params), params.segment
    parts = [codes[at:at + step] for at in range(0, len(codes), step)] or [b""]
    ends = [costs.at_end()]
    for part in reversed(parts[1:]):
        after = ends[-1]
        for code in reversed(part):
            after = costs.before(code, after)
        ends.append(after)
    audit, state, total = [], OTHER, 0
    for s, (part, after) in enumerate(zip(parts, reversed(ends))):
        cost = [after]
        for code in reversed(part):
            cost.append(costs.before(code, cost[-1]))
        if s == 0:
            total = cost[-1][OTHER]
        edits, state = least_path(np.array(cost[::-1]), part, state, params, s == len(parts) - 1)
        audit += edits
    return total, "".join(map(EDITS.__getitem__, audit))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in: (conv_id, turn, role, text, copies); no copies of a dropped row."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(text("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, code, copies): rows without texts; a conversation's dropped rows are one of DROPPED."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    lean = rows.filter("copies > 0").select("conv_id", "turn", turn_digest(F.col("role"), F.col("text")).alias("digest"),
                                            (4 * fault + initial).alias("code"), "copies")
    # Equal rows of a turn are counted before they are shuffled.
    lean = lean.groupBy("conv_id", "turn", "digest", "code").agg(F.sum("copies").alias("copies"))
    first = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first())) == 1
    lean = lean.withColumn("first", first)
    gone = rows.filter("copies = 0").select("conv_id").distinct().select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("digest"), F.lit(4 * DROPPED).alias("code"),
        F.lit(1).cast("long").alias("copies"), F.lit(True).alias("first"))
    return lean.unionByName(gone)


class Conversation:
    """Counts and codes of one conversation, row by row."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.codes, self.turns, self.lowest, self.highest = conv_id, bytearray(), 0, None, None
        self.count, self.illegal = [0] * 4, 0

    def add(self, turn: int | None, code: int, copies: int, first: bool) -> None:
        if code == 4 * DROPPED:
            return
        if turn is not None and turn != self.highest:
            self.turns, self.highest = self.turns + 1, turn
            self.lowest = turn if self.lowest is None else self.lowest
        fault, initial = divmod(code, 4)
        again = code if fault == BLANK else 4 * DUPLICATE + initial
        legal = {SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
        if self.codes:
            self.illegal += initial not in legal.get(self.codes[-1] % 4, ())
        self.illegal += copies - 1   # no initial may follow itself
        self.codes += bytes([code if first else again]) + bytes([again]) * (copies - 1)
        self.count[(code if first else again) // 4] += 1
        self.count[again // 4] += copies - 1

    def row(self, params: RepairParams, known: dict[bytes, tuple[int, str]]) -> dict:
        codes = bytes(self.codes)
        if (found := known.get(codes)) is None:
            found = repair(codes, params)
            if len(codes) <= SHORT and len(known) < KNOWN:   # most conversations are short and look alike
                known[codes] = found
        cost, audit = found
        gaps = 0 if self.lowest is None else min(self.highest - self.lowest + 1 - self.turns, 2 ** 63 - 1)
        return dict(zip(["conv_id", *COUNTS, "audit"], [
            self.conv_id, gaps, *(self.count[f] for f in (BLANK, DUPLICATE, TRUNCATED)), self.illegal, cost, audit]))


class Repaired:
    """Hash of a repaired conversation, fed row by row by its audit; lines are yielded where they are wanted."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last, self.hash, self.empty = audit, 0, OTHER, hashlib.sha256(), True

    def line(self, role: str, text: str) -> None:
        if not self.empty:
            self.hash.update(b"\n")
        self.empty = False
        self.hash.update(f"{role}:{text}".encode())

    def insert(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self.last = ASSISTANT if self.last == USER else USER
            self.line(ROLE[self.last], "")

    def row(self, role: str, text: str) -> None:
        self.insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            follows = ASSISTANT if self.last == USER else USER
            self.last = SYSTEM if edit == "K" and role[:1] == "s" else follows
            self.line(role if edit == "K" else ROLE[follows], text)

    def digest(self) -> str:
        self.insert()
        return self.hash.hexdigest()


ROLE = {USER: "user", ASSISTANT: "assistant"}


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def audits(rows: DataFrame, params: RepairParams) -> DataFrame:
    """Counts, cost and audit of every conversation of damaged rows."""
    n, schema = n_partitions(rows.sparkSession), arrow_schema(SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known = None, {}
        for b in batches:
            out = []
            for conv, turn, code, copies, first in zip(*(b[c].to_pylist() for c in ("conv_id", "turn", "code", "copies", "first"))):
                if now is None or conv != now.conv_id:
                    if now is not None:
                        out.append(now.row(params, known))
                    now = Conversation(conv)
                now.add(turn, code, copies, first)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row(params, known)], schema)
    return (faults(rows).repartition(n, "conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "digest")
            .mapInArrow(run, SCHEMA))


def repaired(conversations: DataFrame, params: RepairParams = RepairParams()) -> DataFrame:
    """Every conversation's faults, cost, audit and the hash of its repaired rows, after the damage."""
    n = n_partitions(conversations.sparkSession)
    rows = damaged(conversations)
    audit = stage(audits(rows, params), "repair-audits")
    texts = rows.filter("copies > 0").select(
        "conv_id", F.lit(1).alias("behind"), "turn", turn_digest(F.col("role"), F.col("text")).alias("digest"), "role", "text",
        "copies", *[F.lit(None).cast("long").alias(c) for c in COUNTS])
    heads = audit.select("conv_id", F.lit(0).alias("behind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("digest"),
                         F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(1).alias("copies"), *COUNTS)
    ddl = f"{SCHEMA}, repaired_sha256 string"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, hashed = None, None
        for b in batches:
            out = []
            behind, copies = b["behind"].to_pylist(), b["copies"].to_pylist()
            for i in range(b.num_rows):   # a text at a time: batches may be large
                text = b["text"][i].as_py()
                if not behind[i]:
                    if head:
                        out.append(head | {"repaired_sha256": hashed.digest()})
                    head, hashed = {c: b[c][i].as_py() for c in ("conv_id", *COUNTS)} | {"audit": text}, Repaired(text)
                else:
                    role = b["role"][i].as_py()
                    for _ in range(copies[i]):
                        hashed.row(role, text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if head:
            yield pa.RecordBatch.from_pylist([head | {"repaired_sha256": hashed.digest()}], schema)
    return (texts.unionByName(heads).repartition(n, "conv_id")
            .sortWithinPartitions("conv_id", "behind", F.col("turn").asc_nulls_first(), "digest").mapInArrow(run, ddl))
