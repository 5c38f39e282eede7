"""BPE codec against tiktoken, packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from helpers import documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return bpe.PieceEncoder(bpe.tokenizer_from_ranks(RANKS, public_tokenizers.PATTERN))


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS),
                             special_tokens={})


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode([text])[0], "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("aabBst'.,12 \n\t 　\u0085éß日\U0001F600́#")) | st.characters(
    exclude_categories=["Cs"]), max_size=40))
def test_encoding_equals_tiktoken(encoder, reference, text):
    assert ids_of(encoder, text) == reference.encode_ordinary(text)


def test_every_code_point_encodes_as_tiktoken_does(encoder, reference):
    points = [c for c in range(0, 0x110000, 13) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}1 {chr(c)}b  {chr(c)}" for c in points]
    found = encoder.encode(texts)
    assert all(np.frombuffer(f, "<u4").tolist() == reference.encode_ordinary(t) for f, t in zip(found, texts))


def test_long_texts_and_special_strings(encoder, reference):
    for text in ("w" * 100_000, " " * 5000 + "x", "ab " * 50_000, "<|endoftext|> a", "a\n\n b", " a", "a ", "  "):
        assert ids_of(encoder, text) == reference.encode_ordinary(text)


def test_json_tokenizer_by_pieces(encoder):
    with open(JSON, encoding="utf-8") as f:
        own = bpe.PieceEncoder(f.read())
    whole = Tokenizer.from_file(JSON)   # as it comes: an added token in a text is that token
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "the", " ", " ", "\n", "'s", "12", ".", "é", "  ", "Zx", ",\nB"]) for _ in range(30))
             for _ in range(400)] + ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|>\n<|endoftext|> y", "<|endoftext"]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in want[-4]
    for many in (1, 7, len(texts)):   # alone, and with others in a batch
        got = [e for at in range(0, len(texts), many) for e in own.encode(texts[at:at + many])]
        assert [np.frombuffer(e, "<u4").tolist() for e in got] == want


def test_a_worker_encodes_small_slices_and_gives_memory_back(monkeypatch):
    class Rows:
        def mapInArrow(self, run, schema):
            return run

    class Whole:
        path, load = "whole", staticmethod(lambda: ("", []))

    class Encoder:
        def encode(self, texts):
            sizes.append(sum(map(len, texts)))
            return [b""] * len(texts)
    sizes, given_back = [], []
    monkeypatch.setattr(bpe, "per_worker", lambda key, make: Encoder())
    monkeypatch.setattr(bpe, "give_back", lambda: given_back.append(1))
    run = bpe.map_encoded(Rows(), Whole(), ["doc_id"], "", lambda texts, encoded, table: {"n": pa.array([len(t) for t in texts])})
    texts = ["x" * 2_000] * 1_000 + ["y" * 3_000_000, "z"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    out = list(run(iter([batch])))
    assert [n for b in out for n in b["n"].to_pylist()] == list(map(len, texts))
    assert max(n for n in sizes if n < 3_000_000) <= bpe.SLICE <= 1 << 19 and len(given_back) == len(out) > 4


def test_words_are_listed_at_once_and_looked_up_once(encoder, monkeypatch):
    class Counting(dict):
        asked = 0

        def get(self, *args):
            Counting.asked += 1
            return super().get(*args)

        def __getitem__(self, key):
            Counting.asked += 1
            return super().__getitem__(key)
    for kind in (pa.string(), pa.large_string()):
        words = pa.array(["a", "é", "the", "Zebra"], kind)
        assert bpe.plain_words(words) == words.to_pylist() and bpe.plain_words(words[1:3]) == ["é", "the"]
        assert bpe.plain_words(words[:0]) == []
    monkeypatch.setattr(encoder, "known", {" ": Counting(), "": Counting()})
    monkeypatch.setattr(encoder, "stored", {" ": bpe.NOTHING, "": bpe.NOTHING})
    first, ends = encoder._words(pa.array(["the", "zebra", "é"]), " ")
    again, cuts = encoder._words(pa.array(["new", "é", "the", "other"]), " ")
    assert Counting.asked == 7
    assert again[cuts[1]:cuts[2]].tolist() == first[ends[2]:ends[3]].tolist() == ids_of(encoder, "a é")[1:]
    assert again[cuts[3]:cuts[4]].tolist() == ids_of(encoder, "a other")[1:]


def test_word_store_is_bounded_and_harmless(reference, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 50)
    own = bpe.PieceEncoder(bpe.tokenizer_from_ranks(RANKS, public_tokenizers.PATTERN))
    rng = random.Random(4)
    for _ in range(30):
        texts = [" ".join(rng.choice("abé") * rng.randint(1, 9) + rng.choice(["", ".", "\nDe", ",\nf!"]) for _ in range(20))
                 for _ in range(3)]
        assert [np.frombuffer(e, "<u4").tolist() for e in own.encode(texts)] == [reference.encode_ordinary(t) for t in texts]
        assert all(len(k) <= 60 for k in own.known.values())


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_decoding_and_offsets(encoder, text):
    text = text.encode("utf-8", "ignore").decode()
    table = bpe.token_bytes(bpe.read_ranks(RANKS))
    ids = np.array(ids_of(encoder, text), np.int64)
    assert bpe.decode_text(ids, table) == text
    spans = bpe.offsets(text, ids, np.array([len(t) for t in table]))
    for i, (a, b) in zip(ids, spans):  # the characters that a token touches hold all its bytes
        assert table[i] in text[a:b].encode() and b > a
    if len(spans):
        assert spans[0, 0] == 0 and spans[-1, 1] == len(text)


def test_split_character_decodes_to_replacements(encoder):
    table = bpe.token_bytes(bpe.read_ranks(RANKS))
    ids = np.array(ids_of(encoder, "\U0001F9FF"), np.int64)
    assert len(ids) > 1 and "�" in bpe.decode_text(ids[:1], table)


def test_codec_on_odd_rows(spark, reference):
    rows = odd_documents()
    codec = bpe.Codec(spark, RANKS, public_tokenizers.PATTERN)
    docs = documents(spark, rows, clashing=True)
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                 for r in bpe.digests(docs, codec).collect())

    def digests(text):
        ids = np.array(reference.encode_ordinary(text), "<u4")
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
    assert got == sorted((r[0] or -1, *digests(r[1] or "")) for r in rows)
    encoded = bpe.encode(docs, codec)
    back = sorted((r["doc_id"] or -1, r["text"]) for r in bpe.decode(encoded, codec).collect())
    assert back == sorted((r[0] or -1, r[1] or "") for r in rows)
    assert bpe.digests(documents(spark, []), codec).count() == 0


def check_pack(spark, rows, params=packing.PackingParams(), most_padding=None):
    codec = packing.JsonCodec(spark, JSON)
    docs = documents(spark, rows, clashing=True)
    pieces = packing.pack(docs, codec, params).collect()
    whole = Tokenizer.from_file(JSON)
    want = sorted((-1 if r[0] is None else r[0], tuple(whole.encode(r[1] or "", add_special_tokens=False).ids) + (1,)) for r in rows)
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append(p)
    for w in windows.values():
        at = 0
        for p in sorted(w, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= params.window
    by_doc = {}
    for d, ids in want:
        by_doc.setdefault(d, []).append(ids)
    covered = {}
    for p in pieces:
        d, s, n = p["doc_id"] if p["doc_id"] is not None else -1, p["start"], p["length"]
        copies = [ids for ids in by_doc[d] if len(ids) == p["doc_tokens"]
                  and zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()) == p["ids_crc32"]]
        assert copies, p
        covered[d] = covered.get(d, 0) + n
    assert covered == {d: sum(map(len, v)) for d, v in by_doc.items()}
    total = sum(p["length"] for p in pieces)
    if most_padding is not None:
        assert params.window * len(windows) - total <= most_padding * total
    return docs, codec, pieces


def test_packing_covers_every_id_once(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["the", "of", "zebra", "x1"]) for _ in range(rng.randint(0, 900))))
            for i in range(300)]
    check_pack(spark, rows, packing.PackingParams(window=512), 0.03)


def test_packing_lengths_that_do_not_fit_together_are_cut(spark):
    rows = [(i, " ".join(["the"] * 299)) for i in range(200)]
    _, _, pieces = check_pack(spark, rows, packing.PackingParams(window=512), 0.08)
    assert len(pieces) > 200


def test_packing_odd_rows_and_sequences(spark):
    check_pack(spark, [*odd_documents(), (90, "a<|endoftext|>b", "en")])
    assert packing.pack(documents(spark, []), packing.JsonCodec(spark, JSON)).count() == 0
    rows = [(i, "the " * (40 * i)) for i in range(12)]
    docs, codec, pieces = check_pack(spark, rows, packing.PackingParams(window=256))
    out = packing.sequences(spark.createDataFrame(pieces), docs, codec, packing.PackingParams(window=256)).collect()
    assert sum(len(r["ids"]) for r in out) == sum(p["length"] for p in pieces)
    for r in out:
        for p in (p for p in pieces if p["sequence_id"] == r["sequence_id"]):
            part = r["ids"][p["offset"]:p["offset"] + p["length"]]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == p["ids_crc32"]


def test_least_squares_is_non_negative_and_optimal():
    rng = np.random.default_rng(8)
    for _ in range(20):
        a, b = rng.random((8, 20)), rng.random(8)
        x = packing.non_negative_least_squares(a, b)
        gradient = a.T @ (b - a @ x)
        assert x.min() >= 0 and gradient.max() < 1e-5 and np.abs(gradient[x > 1e-9]).max(initial=0) < 1e-5


def test_plan_uses_no_more_than_there_is():
    rng = np.random.default_rng(9)
    histogram = {int(u): int(rng.integers(1, 500)) for u in rng.integers(1, 65, 40)}
    params = packing.PackingParams(window=512)
    used = {}
    for lengths, copies in packing.plan_windows(histogram, params):
        assert sum(lengths) <= 64
        for u in lengths:
            used[u] = used.get(u, 0) + copies
    assert all(n <= histogram[u] for u, n in used.items())
