"""Text operators: base counts, lines, toxicity, quality, language; odd rows and held-out accuracy."""

import hashlib
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
from compare import compare, duck
from conftest import SF_MEDIUM, SF_SMALL
from helpers import WS, documents, lower_ascii, odd_documents, words
from pyspark.sql import functions as F

from tidemark.llm import bpe, cotrain, langid, toxicity
from tidemark.llm.line_runs import LineRuns, dedup_lines, drop_lines
from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.quality_rules import Rules, quality, reject_low_quality
from tidemark.llm.queries import QUERIES
from tidemark.llm.shared import held_out, read_table


def test_oracles(spark):
    con = duck(SF_SMALL)
    for name, sql in ORACLE_SQL.items():
        res = compare(QUERIES[name](spark, SF_SMALL), con, sql)
        assert res["columns_match"] and res["types_match"] and res["hash_match"], (name, res)


def base_counts(text):
    w = words(text)
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + o for at in seen.values() if len(at) > 1 for i in at for o in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered))


def test_quality_on_odd_rows(spark):
    rows = odd_documents() + [(20, "a b c a b c a b d x y z " * 6), (21, " ".join(f"t{i}" for i in range(99)) * 2)]
    docs = documents(spark, rows, clashing=True)
    got = quality(docs).collect()
    counts = [(r["doc_id"] or -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
               r["base_failed"]) for r in got]
    want = []
    for r in rows:
        c = base_counts(r[1])
        want.append((r[0] or -1, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert sorted(counts) == sorted(want)
    assert not any(r["kept"] for r in got if r["base_failed"])
    kept = reject_low_quality(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)
    assert quality(documents(spark, [])).count() == 0


def test_quality_rejects_other_distributions_and_spares_short_texts(spark):
    rng = random.Random(1)
    vocabulary = ["the", "of", "and", "in", "to"] * 6 + [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(9)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(200))) for i in range(60)]
    rows += [(100, " ".join(rng.choice(vocabulary).upper() + "!!" for _ in range(200))),
             (101, " | ".join(f"zq{i}" for i in range(150))), (102, " ".join(f"ZQ{i}" for i in range(55)))]
    kept = {r["doc_id"]: r["kept"] for r in quality(documents(spark, rows)).collect()}
    assert all(kept[i] for i in range(60)) and not kept[100] and not kept[101]
    # Below both guards only the base rules speak.
    assert {r["doc_id"]: r["kept"] for r in quality(documents(spark, rows), Rules(min_chars=10**6)).collect()}[102]


def brute_lines(rows, least):
    def key(line):
        return lower_ascii(line.strip(WS))
    found = {}
    for i, r in enumerate(rows):
        for k in {key(x) for x in (r[1] or "").split("\n")} - {""}:
            found.setdefault(k, set()).add(i)
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if len(found.get(key(x), ())) < least]
        out.append((r[0] or -1, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(2)
    lines = [f"line {i}" for i in range(30)] + ["", "  ", "Shared", "\tSHARED \r", "É", "é"]
    rows = [(i, "\n".join(rng.choice(lines[:3] + lines[20:] if i % 2 else lines) for _ in range(rng.randint(0, 12))))
            for i in range(60)] + odd_documents()
    for least in (2, 10, 10**6):
        got = drop_lines(documents(spark, rows, clashing=True), least, name="result").select("doc_id", "result.*").collect()
        assert sorted((r["doc_id"] or -1, r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got) == sorted(
            brute_lines(rows, least))


def test_line_dedup_keeps_columns(spark):
    docs = documents(spark, odd_documents())
    out = dedup_lines(docs, 2)
    assert out.columns == docs.columns and out.count() == docs.count() and out.schema["n_chars"] == docs.schema["n_chars"]
    assert dedup_lines(documents(spark, []), 2).count() == 0


def test_runs_compact_and_keep_first(spark):
    runs = LineRuns(spark, min_docs=3, fanout=2)
    batches = [[(1, 1, 1), (2, 2, 3)], [(1, 1, 1), (3, 3, 1), (2, 2, 1)], [(1, 1, 1)], [(4, 4, 1)], [(4, 4, 1)]]
    for i, b in enumerate(batches):
        df = spark.createDataFrame(b, "h1 long, h2 long, n long")
        novel = {r["h1"] for r in runs.novel(df).collect()}
        assert novel == {x[0] for x in b} - {x[0] for c in batches[:i] for x in c}
        runs.add_batch(df)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {r["h1"]: r["n"] for r in runs.counts().collect()} == {1: 3, 2: 3, 3: 1, 4: 2}
    assert {r["h1"] for r in runs.condemned().collect()} == {1, 2}
    runs.close()


def test_toxicity_finds_held_out_documents(spark):
    got = QUERIES["op3_toxicity"](spark, SF_MEDIUM).join(read_table(spark, SF_MEDIUM, "labels"), "doc_id")
    rows = got.filter("held_out").collect()
    toxic = [r for r in rows if r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.5 * len(toxic)
    assert sum(r["predicted"] for r in rows if not r["toxic"]) <= 0.05 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_toxicity_on_odd_rows(spark):
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)] + [(4, 0, 0), (None, 1, 1), (5, 1, None)],
                                   "doc_id long, quality int, toxic int")
    rows = [(i, " ".join(["plain words here"] * 10 + (["vile beast"] * 4 if i % 4 == 0 else []))) for i in range(20, 200)]
    rows += odd_documents()
    docs = documents(spark, rows, clashing=True)
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in got if r["doc_id"] is not None and r["doc_id"] >= 20)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) if r["doc_id"] is not None
               else r["held_out"] for r in got)
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(1 - r["predicted"] for r in got)
    blank = toxicity.fit(docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(docs, blank).collect()} == {0}
    assert toxicity.score(documents(spark, []), model).count() == 0


def test_toxicity_counts_every_gram(spark):
    """More n-grams than the model in memory may hold give the same scores, from tables."""
    rng = random.Random(12)
    rows = [(i, " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60))
             + (" vilest beasts!" * 5 if i % 4 == 0 else "")) for i in range(20, 90)] + odd_documents()
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(20, 90)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows, clashing=True)
    models = [toxicity.fit(docs, labels, p) for p in (toxicity.ToxicityParams(), toxicity.ToxicityParams(max_grams=50))]
    want, got = (sorted((r["doc_id"] or -1, r["mean_ratio"], r["peak_ratio"], r["score"])
                        for r in toxicity.score(docs, m).collect()) for m in models)
    assert len(got) == len(rows) and np.allclose(got, want, atol=1e-4)
    kept = [toxicity.reject_toxic(docs, m) for m in models]
    assert kept[1].columns == docs.columns and kept[0].count() == kept[1].count() < len(rows)


def test_toxicity_learns_the_words_that_it_scores(spark):
    texts = ["self-made don't", "İstanbul² ½x e\u0301a", "a\u00a0b\u2003c\x1cd", "Ünïcode—dash", "日本 x_y 4th"]
    scored = sorted({w for t in texts for w in (toxicity.NOT_LETTERS.sub("", w) for w in t.lower().split()) if w})
    rows = spark.createDataFrame([(t, 1, 0) for t in texts], "text string, toxic int, fold int")
    got = toxicity.gram_counts(rows).collect()
    grams, _ = toxicity.word_grams(scored)
    assert {r["gram"] for r in got} == set(grams.tolist())


def test_kneser_ney_probabilities_sum_to_one():
    grams, counts = np.unique(toxicity.word_grams(["abra", "cadabra", "abba", "cab"])[0], return_counts=True)
    keys = np.unique(grams & ((1 << 48) - 1))
    low = toxicity.shared_probability(grams, 0.75)
    by_history = {}
    for k, p in {int(k): float(p) for k, p in zip(grams & ((1 << 48) - 1), low)}.items():
        by_history.setdefault(k >> 12, 0.0)
        by_history[k >> 12] += p
    assert len(keys) and all(0 < s <= 1 + 1e-9 for s in by_history.values())
    assert counts.sum() == sum(len(w) + 1 for w in ["abra", "cadabra", "abba", "cab"])


def test_language_of_held_out_documents(spark):
    got = QUERIES["op10_language_id"](spark, SF_MEDIUM).join(
        read_table(spark, SF_MEDIUM, "documents").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_on_odd_rows(spark):
    rows = [(i, "the cat and the dog " * 9 if i % 2 else "der hund und die katze " * 9, "en" if i % 2 else "de")
            for i in range(100, 160)] + odd_documents()
    docs = documents(spark, rows, clashing=True)
    model = langid.fit(docs)
    for mark in ("²", "½ ①", "Ⅷ", "١٢", "ː"):   # no letters but the last
        assert (langid.CentroidModel.predict(model, mark)[0] == "und") == (mark != "ː")
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(r[1])
    for r in got:
        if all(not t or not any(c.isalpha() for c in t) for t in texts[r["doc_id"]]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in set(model.langs)
            if r["doc_id"] >= 100:
                assert r["lang_pred"] == ("en" if r["doc_id"] % 2 else "de")
    assert {r["lang_pred"] for r in langid.identify(docs, langid.fit(docs.limit(0))).collect()} == {"und"}
    assert langid.identify(documents(spark, []), model).count() == 0


def test_ngrams_do_not_depend_on_chunks(monkeypatch):
    text = "Ein ganz kurzer Text, 3 Zeilen!\n" * 40
    want = langid.ngram_counts(text, 512)
    monkeypatch.setattr(langid, "CHUNK", 7)
    assert np.array_equal(want, langid.ngram_counts(text, 512))


def test_co_training_on_held_out_documents(spark):
    got = QUERIES["op8_quality_classifier"](spark, SF_MEDIUM).join(read_table(spark, SF_MEDIUM, "labels"), "doc_id")
    rows = got.filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.9 * len(rows)


def test_co_training_on_odd_rows(spark):
    docs = documents(spark, odd_documents(), clashing=True)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = cotrain.fit(docs, none)
    got = cotrain.score(docs, model).collect()
    assert len(got) == docs.count() and {r["score"] for r in got} == {0.5}
    assert cotrain.score(documents(spark, []), model).count() == 0


def test_pseudo_labels_help_the_other_view():
    """The metadata view has no labelled example of some sources; the content view teaches them."""
    rng = np.random.default_rng(3)
    params = cotrain.CoTrainParams(rounds=3, handed_over=60)

    def views(y, source):
        content = np.column_stack([y + rng.normal(0, 0.2, len(y)), 1 - y + rng.normal(0, 0.2, len(y))]).astype(np.float32)
        return [content, np.eye(6, dtype=np.float32)[source]]
    y = rng.integers(0, 2, 40).astype(float)
    x = views(y, np.where(y == 1, 0, 1))
    z = rng.integers(0, 2, 300).astype(float)
    pool = views(z, np.where(z == 1, 2, 3))
    keys = np.arange(len(z))

    def hand_over(weights, taken, most):
        for v in (0, 1):
            p = cotrain.sigmoid(pool[v] @ weights[v][:-1] + weights[v][-1])
            for label, at in enumerate(cotrain.sure_rows(p, keys, taken[v], most, params.sure)):
                yield from ((v, label, keys[i], [a[i] for a in pool]) for i in at)
    _, meta = cotrain.co_train(x, y, hand_over, params)
    assert meta[2] > 0.1 > -0.1 > meta[3]


def test_hand_over_finds_the_surest_rows_of_the_whole_table(spark):
    """Against scores of all rows at once; repeated rows count once, rows handed over before do not come again."""
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["fine", "words", "spam", "x" * rng.randint(1, 9)]) for _ in range(30)), "en", f"s{i % 5}")
            for i in range(300)]
    rows += rows[:40] + odd_documents()
    docs = documents(spark, rows, clashing=True)
    model = cotrain.CoTrained(cotrain.CoTrainParams(dims=64, sure=0.52))
    r = np.random.default_rng(5)
    weights = [r.normal(0, 1, 68).astype(np.float32), r.normal(0, 1, cotrain.META + 1).astype(np.float32)]
    pool = cotrain.document_rows(docs)
    taken = [np.zeros(0, np.int64)] * 2
    for _ in range(2):
        got = cotrain.pool_hand_over(pool.repartition(5), model)(weights, taken, (7, 4))
        every = {x["key"]: (x["text"], x["source"], x["lang"]) for x in pool.collect()}
        x = model.features(list(every.values()))
        for v in (0, 1):
            p = cotrain.sigmoid(x[v] @ weights[v][:-1] + weights[v][-1])
            bad, good = cotrain.sure_rows(p, np.array(list(every)), taken[v], (7, 4), 0.52)
            want = [(1, list(every)[i]) for i in good] + [(0, list(every)[i]) for i in bad]
            assert want and [(g[1], g[2]) for g in got if g[0] == v] == want
        taken = [np.array([g[2] for g in got if g[0] == v]) for v in (0, 1)]


def test_co_training_with_repeated_ids_and_odd_rows(spark):
    rows = [(i, ("good clear prose of some length " if i % 2 else "buy now !!! $$$ ") * 20, None if i % 3 else "en",
             None if i % 5 == 0 else "s") for i in range(400)]
    rows += [rows[1]] * 300 + odd_documents()
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(150)] + [(1, 1, 0), (2, 1, 0), (None, 1, 1), (3, None, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = documents(spark, rows, clashing=True)
    model = cotrain.fit(docs, labels)
    got = cotrain.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got if (r["doc_id"] or 0) >= 20)
    assert len(cotrain.labelled_sample(docs, cotrain.label_marks(labels), model)) <= 150


def test_held_out_rows_are_never_learned_from(spark):
    ids = spark.range(50).select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("x")).collect()
    assert all(r["x"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in ids)
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]


def test_toxicity_workers_let_go_of_what_other_operators_keep(monkeypatch):
    class Rows:
        sparkSession, schema = None, ""

        def mapInArrow(self, run, schema):
            return run

    class Model(toxicity.KneserNeyRatio):
        def evidence(self, texts, cache):
            sizes.append(sum(map(len, texts)))
            assert "_tidemark_worker" not in sys.modules
            return super().evidence(texts, cache)
    sizes = []
    model = Model(*[np.zeros(0, np.int64)] * 3, toxicity.ToxicityParams())
    monkeypatch.setattr(toxicity, "ship", lambda spark, m: lambda: m)
    texts = ["x" * 2_000] * 1_000 + ["y", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array([1] * len(texts))],
                                       ["doc_id", "text", "toxic"])
    for run in (toxicity.reject_toxic(Rows(), model), toxicity.evidence(Rows(), model, "toxic int")):
        bpe.per_worker("tokenizer", lambda: bytearray(1000))
        assert "_tidemark_worker" in sys.modules
        assert sum(b.num_rows for b in run(iter([batch]))) == len(texts)
    assert max(sizes) <= bpe.SLICE
