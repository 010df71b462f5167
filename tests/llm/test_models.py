import math
import os
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fixtures as X  # noqa: E402
from sacctlens.llm import langid, maskedlm, quality, queries  # noqa: E402

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return X.frame(spark, X.corpus())


def out_of_sample(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


# --- op5

def test_bundles_equal_sums_of_bound_vectors():
    letters, vectors = langid.letter_vectors(64), langid.Vectors(64, kept=40)
    slot = langid.slot_table()
    for text in ("Où est-ce?", "a", "straße 12 Straße", "мир! ελληνικά", "x" * 500, "the cat and the hat sat on that mat"):
        points = [slot[ord(c)] for c in text.lower()]
        gapped = [0]
        for p in [*points, 0]:
            if p or gapped[-1]:
                gapped.append(int(p))
        want = sum((np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c] for a, b, c in zip(gapped, gapped[1:], gapped[2:])), np.zeros(64))
        codes, n = np.unique(langid.trigrams(text), return_counts=True)
        assert np.array_equal(vectors.bundle(codes, n), want)
    assert len(langid.trigrams("12 !?")) == len(langid.trigrams("")) == 0


def test_language_id_rows(spark, docs):
    got = langid.identify(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert all(r.held_out == out_of_sample(r.doc_id) for r in got)
    assert [by_id[i].lang_pred for i in (402, 403, 404, 407)] == ["und"] * 4
    assert by_id[402].score == 0 and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got} <= {"en", "fr", "und"}
    truth = {i: lang for i, _, lang, _ in X.corpus() if i < 100}
    assert np.mean([by_id[i].lang_pred == truth[i] for i in truth]) > 0.95
    empty = X.frame(spark, [])
    assert langid.identify(empty).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, *langid.learn(empty)).collect()} == {"und"}
    kept = langid.accepted(docs, *langid.learn(docs))
    assert kept.columns == docs.columns and {402, 403, 404, 407}.isdisjoint({r.doc_id for r in kept.collect()})


def test_language_id_ignores_other_columns(docs):
    model = langid.learn(docs)
    plain = {(r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, *model).collect()}
    changed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy")})
    assert plain == {(r.doc_id, r.lang_pred, r.score) for r in langid.predict(changed, *model).collect()}


def test_language_id_held_out_accuracy(spark):
    got = queries.op5_language_id(spark, SF01).alias("p").join(spark.read.parquet(f"{SF01}/documents.parquet").alias("d"), "doc_id")
    assert got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


# --- op8

def test_linear_time_score_equals_the_pairwise_sum():
    rng = np.random.default_rng(0)
    texts = pa.array(["one two two THREE!!", "", None, "a | b | c\na | b | c", "é ß 12 34"])
    ptr, idx, val, stats = quality.features(texts)
    k, total = 3, quality.BUCKETS + stats.shape[1]
    m = quality.Machine(0.3, rng.normal(size=total), rng.normal(size=(total, k)), stats.mean(0), np.ones(stats.shape[1]))
    got = m.scores(ptr, idx, val, stats)
    for row in range(5):
        i = np.concatenate((idx[ptr[row]:ptr[row + 1]], np.arange(quality.BUCKETS, total)))
        x = np.concatenate((val[ptr[row]:ptr[row + 1]], np.clip(stats[row] - stats.mean(0), -4, 4)))
        z = 0.3 + x @ m.w[i] + sum((m.v[i[a]] @ m.v[i[b]]) * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert got[row] == pytest.approx(1 / (1 + np.exp(-z)))


def test_features_do_not_depend_on_neighbours():
    texts = [t for _, t, *_ in X.corpus()]
    ptr, idx, val, stats = quality.features(pa.array(texts))
    for i, t in enumerate(texts):
        p, a, b, s = quality.features(pa.array([t]))
        assert np.array_equal(a, idx[ptr[i]:ptr[i + 1]]) and np.allclose(b, val[ptr[i]:ptr[i + 1]]) and np.allclose(s[0], stats[i])


def test_quality_rows(spark, docs):
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(60)] + [(None, 1, 0), (5, None, 0), (6, 7, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == out_of_sample(r.doc_id) for r in got)
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(X.frame(spark, []), labels).count() == 0


def test_quality_held_out(spark):
    got = queries.op8_quality(spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert (got.predicted == got.quality).mean() > 0.95
    assert (good.score.to_numpy()[:, None] > bad.score.to_numpy()).mean() > 0.97


# --- op7

def test_log_probabilities_are_a_distribution():
    counts = np.arange(maskedlm.SYMBOLS, dtype=float)
    net = maskedlm.Network.start(counts)
    symbols = np.array([0, 0, 5, 700, 3, 3, 1023, 0, 0])
    total = 0.0
    for s in range(maskedlm.SYMBOLS):
        symbols[4] = s
        total += np.exp(net.log_probabilities(symbols, np.array([4]))[0])
    assert total == pytest.approx(1, abs=1e-4)


def test_training_lowers_the_loss_and_order_matters():
    rng = random.Random(1)
    # words come in fixed pairs, so both neighbours tell much
    pairs = [(f"a{i}", f"b{i}") for i in range(40)]
    text = " ".join(w for _ in range(20000) for w in rng.choice(pairs))
    slots, rows = maskedlm.slots_of(pa.array([text]))
    counts = np.bincount(slots, minlength=maskedlm.SLOTS)
    symbol = maskedlm.symbol_table(counts)
    net = maskedlm.Network.start(np.bincount(symbol, weights=counts, minlength=maskedlm.SYMBOLS))
    before = net.log_probabilities(*maskedlm.padded(slots, rows, symbol)).mean()
    maskedlm.Trainer(net).learn(*maskedlm.padded(slots, rows, symbol))
    after = net.log_probabilities(*maskedlm.padded(slots, rows, symbol)).mean()
    mixed = net.log_probabilities(*maskedlm.padded(np.random.default_rng(0).permutation(slots), rows, symbol)).mean()
    assert after > before + 1 and after > mixed + 1


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    net = maskedlm.Network.start(np.ones(maskedlm.SYMBOLS))
    symbols = rng.integers(1, maskedlm.SYMBOLS, 40)
    at = np.arange(2, 38)
    loss = lambda f: -maskedlm.Network(f).log_probabilities(symbols, at).mean()

    class Probe(maskedlm.Trainer):
        def _move(self, part, index, grad):
            self.grads = getattr(self, "grads", [np.zeros(s) for s in net.SHAPES])
            self.grads[part][index] += grad

    probe = Probe(net)
    probe.learn(symbols, at)
    flat = np.concatenate([g.ravel() for g in probe.grads])
    for i in np.argsort(-np.abs(flat))[:12]:
        up, down = net.flat.copy(), net.flat.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        assert (loss(up) - loss(down)) / 2e-2 == pytest.approx(flat[i], rel=0.1, abs=2e-3)


def test_lm_rows(spark, docs):
    symbol, net = maskedlm.fit(docs)
    got = maskedlm.score(docs, symbol, net).collect()
    assert len(got) == docs.count()
    texts = dict((i, t) for i, t, *_ in X.corpus())
    for r in got:
        assert r.n_words == len(X.words(texts[r.doc_id]))
        assert (r.mean_log_likelihood is None) == (r.n_words == 0) and r.log_likelihood <= 0
    # a document's score is the sum over its own words, whatever its batch
    for i in (1, 405, 409):
        slots, rows = maskedlm.slots_of(pa.array([texts[i]]))
        alone = net.log_probabilities(*maskedlm.padded(slots, rows, symbol)).sum()
        assert next(r.log_likelihood for r in got if r.doc_id == i) == pytest.approx(alone, rel=1e-3)
    empty = X.frame(spark, [])
    assert maskedlm.score(empty, *maskedlm.fit(empty)).count() == 0


def test_lm_scores_the_word_within_its_symbol(spark, docs):
    texts = [t or "" for _, t, *_ in X.corpus()]
    words = maskedlm.count_words(docs)
    count = Counter(w for t in texts for w in X.words(t))
    assert sorted(r.n for r in words.collect()) == sorted(count.values())
    assert np.array_equal(maskedlm.slot_counts(words), maskedlm.count_slots(docs.select("text")))
    symbol, net = maskedlm.fit(docs, words=words)
    of = {w: symbol[maskedlm.slots_of(pa.array([w]))[0][0]] for w in count}
    size = Counter()
    for w, n in count.items():
        size[of[w]] += n
    plain = {r.doc_id: r.log_likelihood for r in maskedlm.score(docs, symbol, net).collect()}
    got = maskedlm.score(docs, symbol, net, words=words).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in X.corpus())
    by_id = dict((i, t) for i, t, *_ in X.corpus())
    for r in got:
        want = plain[r.doc_id] + sum(math.log(count[w] / size[of[w]]) for w in X.words(by_id[r.doc_id]))
        assert r.n_words == len(X.words(by_id[r.doc_id])) and r.log_likelihood == pytest.approx(want, rel=1e-6, abs=1e-6)
    # a word of the same symbol that the corpus lacks scores lower
    known = max((w for w in count if size[of[w]] > count[w] > 1), key=count.get)
    other = next(w for w in (f"zq{i}" for i in range(10**6)) if symbol[maskedlm.slots_of(pa.array([w]))[0][0]] == of[known] and w not in count)
    pair = X.frame(spark, [(1, known, None, None), (2, other, None, None)])
    low = {r.doc_id: r.log_likelihood for r in maskedlm.score(pair, symbol, net, words=words).collect()}
    assert low[2] < low[1]
    empty = X.frame(spark, [])
    assert maskedlm.score(empty, symbol, net, words=maskedlm.count_words(empty)).count() == 0


def test_lm_scores_do_not_depend_on_the_words_sent(spark, docs):
    words = maskedlm.count_words(docs)
    n = sorted((r.n for r in words.collect()), reverse=True)
    for most in (0, 3, 50, len(n)):
        hashes, times = maskedlm.frequent_words(words, most)
        assert len(hashes) <= most and (np.diff(hashes.astype(object)) > 0).all()
        assert sorted(times, reverse=True) == n[:len(times)] and (most < len(n) or len(times) == len(n))
    symbol, net = maskedlm.fit(docs, words=words)
    want = {r.doc_id: r for r in maskedlm.score(docs, symbol, net, words=words, often=0).collect()}
    for often in (50, len(n)):
        got = maskedlm.score(docs, symbol, net, words=words, often=often).collect()
        assert len(got) == docs.count()
        for r in got:
            assert r.n_words == want[r.doc_id].n_words
            assert r.log_likelihood == pytest.approx(want[r.doc_id].log_likelihood, rel=1e-9, abs=1e-9)


def test_lm_scores_tables_without_words(spark):
    rows = X.frame(spark, [(1, "", None, None), (2, None, None, None), (3, " \n ", None, None)])
    words = maskedlm.count_words(rows)
    got = maskedlm.score(rows, *maskedlm.fit(rows, words=words), words=words).collect()
    assert sorted((r.doc_id, r.n_words, r.log_likelihood, r.mean_log_likelihood) for r in got) == [(i, 0, 0.0, None) for i in (1, 2, 3)]


@pytest.mark.parametrize("n", [1, 7, 3000])
def test_row_sums_equal_brute_force(n):
    rng = np.random.default_rng(n)
    rows = rng.normal(size=(n, 4)).astype(np.float32)
    keys = np.minimum(rng.geometric(0.02, 4 * n), 900).astype(np.uint16)
    want = {}
    for i, k in enumerate(keys.tolist()):
        want[k] = want.get(k, 0) + rows[i % n].astype(float)
    for at_once in (1, 2, 12):
        got, total = maskedlm._summed(rows, keys, at_once)
        assert sorted(got.tolist()) == sorted(want)
        assert np.allclose(total, [want[k] for k in got.tolist()], atol=1e-4)


def test_a_step_equals_the_plain_one():
    """One batch of the trainer against the same step, written position by position."""
    rng = np.random.default_rng(5)
    start = maskedlm.Network.start(np.arange(maskedlm.SYMBOLS, dtype=float))
    symbols = rng.integers(0, 200, 60)
    at, width = np.arange(2, 58), maskedlm.SYMBOLS // maskedlm.CLASSES
    want = [np.zeros(s) for s in start.SHAPES]
    tables, bias, w, b, v, c = (p.astype(float) for p in start.parts)
    places = [-2, -1, 1, 2]
    for i in at:
        h = np.tanh(bias + sum(tables[k][symbols[i + p]] for k, p in enumerate(places)))
        cls, own = divmod(symbols[i], width)
        d, e = (np.exp(z) / np.exp(z).sum() for z in (h @ w + b, h @ v[cls] + c[cls]))
        d[cls] -= 1
        e[own] -= 1
        d, e = d / len(at), e / len(at)
        back = (w @ d + v[cls] @ e) * (1 - h * h)
        for part, index, g in ((1, ..., back), (2, ..., np.outer(h, d)), (3, ..., d), (4, cls, np.outer(h, e)), (5, cls, e)):
            want[part][index] += g
        for k, p in enumerate(places):
            want[0][k, symbols[i + p]] += back
    net = maskedlm.Network(start.flat.copy())
    maskedlm.Trainer(net).learn(symbols, at)
    for part, g, old in zip(net.parts, want, start.parts):
        assert np.allclose(part, old - maskedlm.RATE * g / np.sqrt(1e-4 + g * g), atol=1e-4)


def test_lm_trains_on_every_position(spark):
    """Where no position is multiple of 8, thinning would leave the network at its start."""
    rows = [(0, "", None, None)] + [(i, "la lo", None, None) for i in range(1, 7)]
    few = X.frame(spark, rows).coalesce(1)
    symbol, net = maskedlm.fit(few)
    counts = maskedlm.count_slots(few.select("text"))
    start = maskedlm.Network.start(np.bincount(symbol, weights=counts, minlength=maskedlm.SYMBOLS))
    learned = np.flatnonzero((net.parts[0] != start.parts[0]).any(axis=(0, 2)))
    of = lambda w: symbol[maskedlm.slots_of(pa.array([w]))[0][0]]
    assert set(learned) == {0, of("la"), of("lo")}
    assert maskedlm.score(few.filter("doc_id = 1"), symbol, net).first().log_likelihood > maskedlm.score(few.filter("doc_id = 1"), symbol, start).first().log_likelihood


def test_lm_counts_cover_all_documents(docs):
    want = np.zeros(maskedlm.SLOTS, np.int64)
    for _, text, *_ in X.corpus():
        np.add.at(want, maskedlm.slots_of(pa.array([text]))[0], 1)
    assert np.array_equal(maskedlm.count_slots(docs.select("text")), want)
