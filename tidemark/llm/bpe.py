"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A tokenizer is built from a rank file (base64 token and rank a line): bytes are
written as the printable characters of the byte-to-character table, merges are
what the ranks imply, and each match of the split pattern is encoded on its own.

Encoding works on the distinct pieces of a batch. A text may be cut before a
blank that stands alone between two other characters: every match of the pattern
ends there, as a match takes at most the one blank before it. Arrow splits the texts
and finds the distinct pieces, the library encodes these once a batch, and numpy
gathers their ids. Texts with added tokens of the library go to it whole. Whole texts
are covered, whatever their length.

Decoding turns ids back into bytes through the reversed table. Tokens may split
a character: offsets name the characters that a token touches, and text decoding
replaces an incomplete character at the ends only.

Defined results: null text counts as empty and has no tokens. Repeated rows get
equal results. Only doc_id and text are read.
"""

from __future__ import annotations

import base64
import ctypes
import hashlib
import os
import re
import sys
import types
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Python's white space holds all that the pattern has, so a cut is never made inside a run of it.
CUT = re.compile(r"(?<=\S)(?= \S)")


def byte_table() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(other)) for b in range(256)]


TO_SHOWN = dict(enumerate(byte_table()))
# A word, marks, and perhaps the first word of the next line: each is a match of the pattern, and so is the line
# feed. Letters up to U+024F are letters for every library.
_LETTERS, _MARKS = "[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+", "[!-/:-@\\[-`{-~]+"
SHAPE = f"^(?P<head>{_LETTERS})(?P<marks>{_MARKS})?(?:\\n(?P<word>{_LETTERS})(?P<more>{_MARKS})?)?$"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def implied_merges(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The last merge that makes each token, in rank order."""
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            at = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank))
            if ranks.get(parts[at] + parts[at + 1], rank) >= rank:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            merges.append((parts[0], parts[1]))
    return merges


def tokenizer_from_ranks(path: str, pattern: str) -> str:
    """A tokenizers definition (JSON) that encodes as the ranks say."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers
    ranks, table = read_ranks(path), byte_table()

    def show(token: bytes) -> str:
        return "".join(table[b] for b in token)
    model = models.BPE(vocab={show(t): r for t, r in ranks.items()},
                       merges=[(show(a), show(b)) for a, b in implied_merges(ranks)], ignore_merges=True)
    t = Tokenizer(model)
    t.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return t.to_str()


NOTHING = np.zeros(0, np.uint32), np.zeros(1, np.int64)
KNOWN_WORDS = 200_000
SLICE = 1 << 19   # characters encoded at once: what a worker holds beside its tokenizer grows with them


def gather(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``index`` of a ragged array (values, offsets), one after the other, as a ragged array."""
    lengths = offsets[index + 1] - offsets[index]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(offsets[index] - ends + lengths, lengths) + np.arange(total)], np.concatenate([[0], ends])


def plain_words(words: pa.Array) -> list[str]:
    """The strings of an array of words without blanks; ``to_pylist`` makes a scalar of each, which takes ten times as long."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), pa.scalar(" ", words.type))[0].as_py().split(" ")


class PieceEncoder:
    """Texts to ids (as bytes of little-endian unsigned 32-bit integers), by the distinct pieces of a batch.

    From one batch to the next only plain words are kept, ``KNOWN_WORDS`` of them at most, so
    memory is bounded by a batch.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_str(definition)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.characters = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        self.characters[list(vocabulary.values())] = list(map(len, vocabulary))
        self.known: dict[str, dict[str, int]] = {" ": {}, "": {}}   # words after a blank, and others: places in ``stored``
        self.stored = {" ": NOTHING, "": NOTHING}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _words(self, words: pa.Array, prefix: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words: one match of the pattern as they stand, so only the merges remain to be run."""
        words = plain_words(words)
        known = self.known[prefix]
        place = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(place < 0)
        if len(known) + len(missing) > KNOWN_WORDS:
            known.clear()
            self.stored[prefix] = NOTHING
            missing = np.arange(len(words))
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            # Bytes as shown; raw blanks part the words, the character for a blank stands before them.
            shown = " ".join(new).encode().decode("latin-1").translate(TO_SHOWN)
            blank, values, offsets = TO_SHOWN[32], *self.stored[prefix]
            given = ((prefix and blank) + shown.replace(blank, " " + (prefix and blank))).split(" ")
            runs = [" ".join(given[at:at + 200]) for at in range(0, len(given), 200)]
            ids = np.concatenate([np.array(e.ids, np.uint32)
                                  for e in self.merges.encode_batch_fast(runs, add_special_tokens=False)])
            # A word's tokens end where their characters have come to the word's.
            ends = np.searchsorted(np.cumsum(self.characters[ids]), np.cumsum(np.fromiter(map(len, given), np.int64)), "left") + 1
            self.stored[prefix] = np.concatenate([values, ids]), np.concatenate([offsets, offsets[-1] + ends])
            place[missing] = np.arange(len(offsets) - 1, len(offsets) - 1 + len(new))
            known.update(zip(new, place[missing].tolist()))
        return gather(*self.stored[prefix], place)

    @staticmethod
    def _run(tokenizer, given: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings that are encoded each on its own, as a ragged array."""
        ids, lengths = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for at in range(0, len(given), 20_000):
            part = given[at:at + 20_000]
            e = tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(e.ids, np.uint32))
            lengths.append(np.bincount(np.array(e.word_ids, np.int64), minlength=len(part)))
        return np.concatenate(ids), np.cumsum(np.concatenate(lengths))

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that stand after a blank, given without it."""
        groups = pc.extract_regex(pieces, SHAPE)
        regular = groups.is_valid().to_numpy(zero_copy_only=False)
        head, marks, word, more = (pc.fill_null(pc.struct_field(groups, f), "") for f in ("head", "marks", "word", "more"))
        has_word = pc.not_equal(word, "")
        heads, words = head.filter(pa.array(regular)).dictionary_encode(), word.filter(has_word).dictionary_encode()
        tails = pa.concat_arrays([marks, more]).dictionary_encode()
        rest = pieces.filter(pa.array(~regular))
        # One ragged array of all parts: heads, words, runs of marks, the line feed, irregular pieces.
        parts = [self._words(heads.dictionary, " "), self._words(words.dictionary, ""),
                 self._run(self.tokenizer, tails.dictionary.to_pylist()), self._run(self.tokenizer, ["\n"]),
                 self._run(self.tokenizer, [" " + p for p in rest.to_pylist()])]
        first = np.cumsum([0, *(len(o) - 1 for _, o in parts)])
        ids = np.concatenate([i for i, _ in parts])
        offsets = np.concatenate([[0], *(o[1:] + at for (_, o), at in zip(parts, np.cumsum([0, *(len(i) for i, _ in parts)])))])
        n, tail = len(pieces), tails.indices.to_numpy()
        table = np.full((n, 5), -1)
        table[regular, 0] = first[0] + heads.indices.to_numpy()
        table[~regular, 0] = first[4] + np.arange(len(rest))
        table[:, 1] = first[2] + tail[:n]   # an empty run has no ids
        has_word = has_word.to_numpy(zero_copy_only=False)
        table[has_word, 2] = first[3]
        table[has_word, 3] = first[1] + words.indices.to_numpy()
        table[:, 4] = first[2] + tail[n:]
        used = table >= 0
        values, ends = gather(ids, offsets, table[used])
        return values, ends[np.concatenate([[0], np.cumsum(used.sum(1))])]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not texts:
            return []
        given = pa.array([t or "" for t in texts], pa.large_string())
        split = pc.split_pattern(given, " ")
        at, flat = split.offsets.to_numpy() - split.offsets[0].as_py(), split.flatten().dictionary_encode()
        index, pieces = flat.indices.to_numpy(), flat.dictionary
        front = np.zeros(len(index), bool)
        front[at[:-1]] = True
        # A piece with white space at an end, or none at all between two blanks, is not a run of whole matches.
        uneven = pc.not_equal(pc.utf8_trim_whitespace(pieces), pieces).to_numpy(zero_copy_only=False)
        empty = pc.equal(pieces, "").to_numpy(zero_copy_only=False)
        ends_blank = pc.not_equal(pc.utf8_rtrim_whitespace(pieces), pieces).to_numpy(zero_copy_only=False)
        odd = np.where(front, ends_blank[index], (uneven | empty)[index])
        slow = np.add.reduceat(odd, at[:-1]) > 0
        special = np.zeros(len(texts), bool)
        for token in self.added:
            special |= pc.match_substring(given, token).to_numpy(zero_copy_only=False)
        whole = ~(slow | special)
        keep = np.repeat(whole, np.diff(at))
        inner, where = np.unique(index[keep & ~front], return_inverse=True)
        start, begin = np.unique(index[keep & front], return_inverse=True)
        inner_ids, inner_at = self._distinct(pieces.take(pa.array(inner)))
        # Pieces at the start of a text have no blank before them.
        start_ids, start_at = self._run(self.tokenizer, pieces.take(pa.array(start)).to_pylist())
        number = np.empty(int(keep.sum()), np.int64)
        number[~front[keep]], number[front[keep]] = where, begin + len(inner)
        ids, ends = gather(np.concatenate([inner_ids, start_ids]),
                           np.concatenate([inner_at, start_at[1:] + inner_at[-1]]), number)
        data = memoryview(ids.astype("<u4").tobytes())
        cuts = (4 * ends[np.concatenate([[0], np.cumsum(np.diff(at)[whole])])]).tolist()
        out: list[bytes] = [b""] * len(texts)
        for i, a, b in zip(np.flatnonzero(whole).tolist(), cuts, cuts[1:]):
            out[i] = bytes(data[a:b])
        parts = {int(i): CUT.split(texts[i]) for i in np.flatnonzero(slow & ~special)}
        distinct = list(set().union(*parts.values()))
        ids, ends = self._run(self.tokenizer, distinct)
        known = {p: ids[a:b].astype("<u4").tobytes() for p, a, b in zip(distinct, ends, ends[1:])}
        for i, own in parts.items():
            out[i] = b"".join(map(known.__getitem__, own))
        for i in np.flatnonzero(special).tolist():  # the library knows its added tokens in a text
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes()
        return out


def per_worker(key: str, make: Callable[[], object]) -> object:
    """One object a worker process, kept from task to task."""
    kept = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def small_batches(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` characters, so that memory is bounded by a slice or one text."""
    at, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(batch[column]), 0).to_pylist()):
        size += n
        if size > most and i > at:
            yield batch.slice(at, i - at)
            at, size = i, n
    if at < batch.num_rows:
        yield batch.slice(at)


def give_back() -> None:
    """Freed memory goes back to the system: Python workers stay for later stages, and keep what they had at most."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
    if trim is not None:
        trim(0)


def let_go() -> None:
    """Drops what the worker keeps from task to task: another operator runs in it now, which needs the memory."""
    sys.modules.pop("_tidemark_worker", None)
    give_back()


def offsets(text: str, ids: np.ndarray, byte_lengths: np.ndarray) -> np.ndarray:
    """(start, end) of the characters of ``text`` that each token touches."""
    data = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    ends = np.cumsum(byte_lengths[ids])
    starts = ends - byte_lengths[ids]
    return np.column_stack([char[starts], char[ends - 1] + 1]) if len(ids) else np.zeros((0, 2), np.int64)


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def decode_bytes(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join([table[i] for i in ids.tolist()])


def decode_text(ids: np.ndarray, table: list[bytes]) -> str:
    """Text of any run of ids; a character that the run holds only a part of becomes U+FFFD."""
    return decode_bytes(ids, table).decode("utf-8", "replace")


class Codec:
    """What executors need of a rank file: read on the driver, broadcast (a few MB, fixed)."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        from tidemark.llm.shared import ship
        self.path, self.definition = path, tokenizer_from_ranks(path, pattern)
        self.load = ship(spark, (self.definition, token_bytes(read_ranks(path))))


def map_encoded(rows: DataFrame, codec: Codec, keep: list[str], schema: str, make: Callable) -> DataFrame:
    """mapInArrow over (keep..., text): ``make(texts, encoded, table)`` gives the further columns."""
    load, key = codec.load, f"bpe:{codec.path}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition, table = load()
        encoder = per_worker(key, lambda: PieceEncoder(definition))
        for whole in batches:
            for b in small_batches(whole, "text", SLICE):
                texts = b["text"].to_pylist()
                columns = make(texts, encoder.encode(texts), table)
                del texts
                yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), *columns.values()], [*keep, *columns])
                del columns
                give_back()
    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, codec: Codec) -> DataFrame:
    """(doc_id, ids, starts, ends): the tokens of every text and the characters they touch."""
    def make(texts, encoded, table):
        lengths = np.array([len(t) for t in table])
        ids = [np.frombuffer(e, "<u4").astype(np.int64) for e in encoded]
        at = [offsets(t or "", i, lengths) for t, i in zip(texts, ids)]
        kind = pa.list_(pa.int64())
        return {"ids": pa.array(ids, kind), "starts": pa.array([a[:, 0] for a in at], kind),
                "ends": pa.array([a[:, 1] for a in at], kind)}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_encoded(rows, codec, ["doc_id"],
                       "doc_id long, ids array<long>, starts array<long>, ends array<long>", make)


def decode(rows: DataFrame, codec: Codec, ids: str = "ids") -> DataFrame:
    """(doc_id, text) of rows with an array of ids; null ids give null text."""
    load = codec.load

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, table = load()
        for b in batches:
            texts = [None if x is None else decode_text(np.array(x, np.int64), table) for x in b["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(ids).cast("array<long>").alias("ids")
                       ).mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, codec: Codec) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, and its ids decoded again."""
    def make(texts, encoded, table):
        back = [hashlib.sha256(decode_bytes(np.frombuffer(e, "<u4"), table)).hexdigest() for e in encoded]
        return {"n_tokens": pa.array([len(e) // 4 for e in encoded], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(e).hexdigest() for e in encoded]),
                "decoded_sha256": pa.array(back)}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_encoded(rows, codec, ["doc_id"],
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
