"""The maximum-entropy model: unigram sums and scores by plain loops, proper distributions, gradients."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.llm import blocks, maxent

ODD = ["", None, " ", "a\x1cb c\xa0d", "ÀB Àb", "x " * 3000, "\n\t\x0b y\x0c\rz", "never1 never2"]


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None if i == 3 else 10**6 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    return given.union(odd).union(odd.limit(3)).withColumn("score", F.lit("clash")).withColumn("block", F.lit(0)).cache()


@pytest.mark.parametrize("size", [500, 2_000_000])
def test_counts_and_base_equal_plain_loops(spark, docs, size, monkeypatch):
    monkeypatch.setattr(blocks.code_blocks, "__defaults__", (size,))
    monkeypatch.setattr(maxent, "BUCKET_ENTRIES", 10 * size)
    rows = docs.collect()
    count = Counter()
    for r in rows:
        if not held(r.doc_id):
            count.update([*words(r.text), None])
    n, v = sum(count.values()), len(count)
    want = []
    for r in rows:
        tokens = [*words(r.text), None]
        base = sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens)
        want.append((held(r.doc_id), len(tokens), sum(t in count for t in tokens), n, round(base, 6)))
    out = maxent.score_texts(docs, "doc_id", "text")
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = out.collect()
    assert sorted((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    unseen = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) * 0.9
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_without_training_rows_and_without_rows(spark, docs):
    out = maxent.score_texts(docs, "doc_id", "text", F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in out} == {(0, 0, 0.0, 0.0)}
    assert maxent.score_texts(docs.limit(0), "doc_id", "text").count() == 0


def small_model(seed=0):
    rng = np.random.default_rng(seed)
    mass = rng.integers(0, 9, maxent.LEAVES).astype(float)
    mass[32:64] = 0
    return maxent.Maxent(mass, rng.normal(0, 0.3, (maxent.ROWS, maxent.DIGITS)).astype(np.float32))


def test_probabilities_of_all_words_add_up_to_one(spark):
    model = small_model()
    leaves = np.arange(maxent.LEAVES)[model.leaf_prior.ravel() > 0]
    total = 0.0
    for leaf in leaves:  # every possible third token after the same two
        text = np.array([5, 700, leaf], np.uint16)
        _, target, class_rows, leaf_rows = next(maxent.windows(text, np.array([0])))
        total += math.exp(model.log_probability(class_rows, leaf_rows, target)[2])
    assert total == pytest.approx(1, abs=1e-4)
    # shares inside the leaves, and the unknown event, add up as well
    counts = np.array([3, 1, 4])
    vocabulary = maxent.Vocabulary(2, 3, 10, np.array([], np.int64), np.r_[1.5, np.zeros(maxent.FREQUENT - 1), 2.5, 0.5, 3.5, np.zeros(maxent.ENDINGS - 3)])
    shares = 10 ** vocabulary.inner(counts, np.array([512, 513, 514])) / (1 - vocabulary.unknown)
    assert shares == pytest.approx(1)
    assert vocabulary.leaf_mass.sum() / vocabulary.tokens + vocabulary.unknown == pytest.approx(1)


def test_windows_see_their_own_text_only(monkeypatch):
    tokens = np.arange(10, 30, dtype=np.uint16) | (np.arange(20, dtype=np.uint16) << maxent.HASH_BITS)
    starts = np.array([0, 1, 8])
    whole = [np.concatenate([np.stack([t, y, *c, *w]) for t, y, c, w in maxent.windows(tokens, starts)], axis=1)]
    monkeypatch.setattr(maxent, "TOKENS_AT_ONCE", 3)
    whole.append(np.concatenate([np.stack([t, y, *c, *w]) for t, y, c, w in maxent.windows(tokens, starts)], axis=1))
    assert (whole[0] == whole[1]).all()
    alone = [np.stack([y, *c, *w]) for a, b in ((0, 1), (1, 8), (8, 20)) for _, y, c, w in maxent.windows(tokens[a:b], np.array([0]))]
    assert (np.concatenate(alone, axis=1) == whole[0][1:]).all()
    assert whole[0][0].tolist() == [0] + [1] * 7 + [2] * 12


def test_score_and_gradient_by_plain_loops(spark):
    model, rng = small_model(1), np.random.default_rng(2)
    possible = np.flatnonzero(model.leaf_prior.ravel() > 0)
    tokens = rng.choice(possible, 60).astype(np.uint16) | (rng.integers(0, 32, 60) << maxent.HASH_BITS).astype(np.uint16)
    tokens[7] |= maxent.UNKNOWN
    starts, sizes = np.array([0, 20]), [20, 40]
    plain, rows = 0.0, []
    for _, target, class_rows, leaf_rows in maxent.windows(tokens, starts):
        for i, y in enumerate(target):
            for kind, at, prior in ((class_rows, y // 32, model.log_class), (leaf_rows, y % 32, model.log_leaf[y // 32])):
                logits = prior + sum(model.weights[r[i]].astype(float) for r in kind)
                plain += logits[at] - math.log(np.exp(logits).sum())
            rows.append((class_rows[0][i], y // 32))
    assert len(rows) == 59
    frame = spark.createDataFrame([(a, bytearray(tokens[s : s + a].astype("<u2").tobytes()), i, False, a, 0.0, 0.0) for i, (s, a) in enumerate(zip(starts.tolist(), sizes, strict=True))], "n_tokens long, tokens binary, key long, held_out boolean, n_known long, base_score double, inner double")
    scores = maxent._score(frame, model).collect()
    assert sum(r.score for r in scores) == pytest.approx(plain / math.log(10), rel=1e-5)
    gradient = maxent._sums(frame, model)
    row, column = rows[3]
    step = 1e-2
    logs = []
    for sign in (1, -1):
        model.weights[row, column] += sign * step
        logs.append(sum(model.log_probability(c, w, t).sum() for _, t, c, w in maxent.windows(tokens, starts)))
        model.weights[row, column] -= sign * step
    assert (logs[0] - logs[1]) / (2 * step) == pytest.approx(gradient[row, column], abs=2e-3)


def test_updates_together_see_all_training_texts(spark):
    rng = np.random.default_rng(3)
    mass = rng.integers(1, 9, maxent.LEAVES).astype(float)
    texts = [rng.choice(np.arange(40 * i, 40 * i + 40), 30).astype("<u2") for i in range(16)]  # each has leaves of its own
    frame = spark.createDataFrame([(30, bytearray(t.tobytes()), i) for i, t in enumerate(texts)], "n_tokens long, tokens binary, slice int")
    start = maxent.train(frame, mass, ())
    got = maxent.train(frame, mass, (0.5, 0.25))
    moved = np.abs(got.weights - start.weights).max(axis=1) > 1e-4
    for text in texts:
        _, _, class_rows, leaf_rows = next(maxent.windows(text, np.array([0])))
        assert moved[np.concatenate([r[3:] for r in (*class_rows, *leaf_rows)])].all()
    # by hand: every text is in one of the two updates
    met, prior = maxent._sums(frame, None), start.row_priors()
    assert met.sum() == 16 * 30 * 2 * maxent.FEATURES
    scale = np.maximum(met, met.sum(axis=1, keepdims=True) * prior) / 2 + maxent.PRIOR_COUNT
    for i, rate in enumerate((0.5, 0.25)):
        start.weights = start.weights + np.clip(rate * maxent._sums(frame.where(F.col("slice") % 2 == i), start) / scale, -1, 1).astype(np.float32)
    np.testing.assert_allclose(got.weights, start.weights, atol=1e-5)
