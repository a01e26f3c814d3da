"""Language identification and the quality classifier: held-out accuracy, gradients, odd rows."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.llm import language_id, quality, stages
from gridseries.llm.language_id import identify, language_spans, train_on_rest, viterbi, word_script

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_held_out_language_accuracy(docs):
    out = identify(docs, "doc_id", "text", "lang").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98


def test_predictions_ignore_the_label_columns(docs):
    wiped = docs.withColumn("lang", F.when(language_id.is_held_out(F.col("doc_id")), None).otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    a, b = ({r.doc_id: r.lang_pred for r in identify(d, "doc_id", "text", "lang").collect()} for d in (docs, wiped))
    assert a == b


def test_language_of_odd_rows(spark, docs):
    model = train_on_rest(docs, "doc_id", "text", "lang")
    texts = [None, "", "12 34 !!", "the " * 20000, "привет мир"]
    names, scores = model.predict(texts)
    assert names[:4] == ["und", "und", "und", "en"] and scores[:3] == [0, 0, 0]
    odd = spark.createDataFrame([(None, "the and of", None, 1), (5, None, "en", 2), (5, None, "en", 2)], "doc_id long, text string, lang string, score int")
    assert [r.lang_pred for r in identify(odd, "doc_id", "text", "lang").collect()] == ["und"] * 3
    assert identify(docs.limit(0), "doc_id", "text", "lang").count() == 0


def test_mixed_text_is_cut_into_spans(spark, docs):
    rows = docs.where("length(text) > 1500 AND length(text) < 4000 AND lang IN ('en', 'de')").orderBy("doc_id").collect()
    en, de = (next(r.text for r in rows if r.lang == lang and "%%%" not in r.text and "|" not in r.text) for lang in ("en", "de"))
    model = train_on_rest(docs, "doc_id", "text", "lang")
    df = spark.createDataFrame([(1, f"{en} {de} {en}"), (2, "12")], "doc_id long, text string")
    spans = language_spans(df, "doc_id", "text", model).orderBy("span").collect()
    assert [s.lang for s in spans] == ["en", "de", "en"]
    n = len(language_id.words_of(en.lower()))
    assert abs(spans[1].start_word - n) <= 3 and [s.start_word for s in spans][1:] == [spans[0].words, spans[0].words + spans[1].words]


def test_foreign_texts_have_a_low_score_and_mixed_ones_of_learned_languages_keep_theirs(spark, docs):
    model = train_on_rest(docs, "doc_id", "text", "lang")
    en, de = (r.text for lang in ("en", "de") for r in docs.where(f"lang = '{lang}' AND length(text) BETWEEN 1500 AND 4000 AND text NOT RLIKE '[%|$#*]'").orderBy("doc_id").limit(1).collect())
    foreign = [
        "все люди рождаются свободными и равными в своем достоинстве и правах", "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心", "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق",
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem", "人人生而自由在尊严和权利上一律平等 " * 200 + en[:300],
    ]
    mixed = [en, de, f"{en} {en} {de}", f"{en[:1000]} {'привет мир ' * 20}"]
    names, scores = model.predict(foreign + mixed)
    assert set(names) <= set(model.languages) and max(scores[:4]) < 0.3 and names[4] == "en" and scores[4] < 0.2
    assert names[5:] == ["en", "de", "en", "en"] and min(scores[5:7]) > 0.9 and 0.5 < scores[7] < 0.9 and 0.5 < scores[8] < 0.9
    rows = docs.unionByName(spark.createDataFrame([(10**9 + i, t, None, "s", len(t)) for i, t in enumerate(foreign + mixed)], docs.schema))
    left = {r.doc_id for r in stages.keep_known_languages(spark, rows, SF).where(f"doc_id >= {10**9}").select("doc_id").collect()}
    assert left == {10**9 + i for i in range(5, 9)}
    clean = [r.score for r in identify(docs, "doc_id", "text", "lang").where("held_out").collect()]
    assert np.mean(np.array(clean) >= stages.LANGUAGE_SHARE) > 0.99


def test_a_language_of_three_rows_knows_its_own_texts(docs):
    few = docs.where("lang = 'es'").orderBy("doc_id").limit(3)
    model = language_id.train(few, "doc_id", "text", "lang")
    own, other = ([r.text for r in docs.where(f"lang = '{lang}' AND length(text) > 500").orderBy(F.desc("doc_id")).limit(30).collect()] for lang in ("es", "de"))
    assert np.median(model.predict(own)[1]) > 0.8 and max(model.predict(other)[1]) < 0.5


def test_words_are_letters_with_marks_of_one_script():
    words = language_id.words_of
    assert words("² ½ ¼³ 12_3") == [] and words("² ½ ⅷ ① ٣") == []
    assert words("हिन्दी e\u0301te\u0301 μία") == ["हिन्दी", "e\u0301te\u0301", "μία"]
    assert words("日本語のtext") == ["日本語", "の", "text"]
    assert words("人人生而自由在尊严") == ["人人生而", "自由在尊", "严"]
    assert words("don't für²x") == ["don", "t", "für", "x"] and words("ꙁꙁ мирꙁtext") == ["ꙁꙁ", "мирꙁ", "text"]


def test_every_label_trains_however_large_the_table(spark, docs):
    frequent = docs.where("lang IN ('en', 'de')").select("text", "lang")
    rare = docs.where("lang = 'es' AND length(text) > 300").orderBy("doc_id").limit(3).select("text", "lang")
    rows = frequent.union(rare).withColumn("doc_id", F.monotonically_increasing_id())
    model = language_id.train(rows, "doc_id", "text", "lang", max_rows=3)
    assert model.languages == ["de", "en", "es"]


def test_scores_equal_a_plain_loop(docs):
    model = train_on_rest(docs, "doc_id", "text", "lang")
    words = ["house", "für", "x", "niño", "мир", "the"]
    scores, own = model.score_words(words)
    for word, got, mine in zip(words, scores, own, strict=True):
        buckets, there, _ = language_id.word_grams([word])
        padded = f" {word} "
        grams = [padded[i : i + k] for k in language_id.GRAM_SIZES for i in range(len(padded) - k + 1) if padded[i : i + k] != " "]
        assert there.sum() == len(grams)
        hashed = [int(b) for row, mask in zip(buckets, there, strict=True) for b in row[mask]]
        sums = [sum(float(model.grams[lang, b]) for b in hashed) for lang in range(len(model.languages))]
        cand = [bool(model.in_script[lang, word_script(word)]) for lang in range(len(model.languages))]
        if not any(cand):
            assert not got.any() and not mine.any()
            continue
        mean = np.mean([s for s, c in zip(sums, cand, strict=True) if c]) / 3
        want = [np.clip(s / 3 - mean, -20, 20) if c else -30 for s, c in zip(sums, cand, strict=True)]
        assert np.allclose(got, want, atol=1e-3)
        assert mine.tolist() == [c and s >= len(grams) * f for s, c, f in zip(sums, cand, model.floors, strict=True)]


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    scores = rng.normal(size=(12, 3)).astype(np.float32)
    texts = [rng.integers(0, 12, n).astype(np.int32) for n in (6, 0, 1, 5, 6, 3)]
    for ids, path in zip(texts, viterbi(texts, scores, 0.7), strict=True):
        value = lambda p: sum(scores[i, s] for i, s in zip(ids, p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(map(value, itertools.product(range(3), repeat=len(ids))), default=0)
        assert len(path) == len(ids) and abs(value(path.tolist()) - best) < 1e-4


def test_scripts():
    name = lambda w: language_id.SCRIPTS[word_script(w)]
    assert [name(w) for w in ("word", "été", "мир", "λόγος", "日本", "かな", "한글", "עברית", "ꙁ")] == ["latin", "latin", "cyrillic", "greek", "han", "kana", "hangul", "hebrew", "other"]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_quality(docs, labels):
    out = quality.classify(docs, "doc_id", "text", labels, "doc_id", "quality")
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert all(r.predicted == (r.score >= 0.3) and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    good, bad = (np.array([r.score for r in rows if r.quality == q]) for q in (1, 0))
    assert (good[:, None] > bad[None]).mean() > 0.95 and (good >= 0.3).mean() > 0.97


def test_gradients_are_the_losses_slopes():
    rng = np.random.default_rng(2)
    bags = [np.abs(rng.normal(size=(n, quality.N_FEATURES))).astype(np.float32) for n in (1, 3, 2, 5)]
    y = np.array([1.0, 0, 1, 0])
    model = quality.fit(bags, y, epochs=1)
    x, sizes = np.concatenate([model.standard(b) for b in bags]).astype(float), np.array([1, 3, 2, 5])
    grads = model.gradients(x, sizes, y)

    def loss():
        p = model._forward(x, sizes)["y"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for k, w in model.weights.items():
        at = tuple(0 for _ in w.shape)
        old = w[at]
        w[at] = old + 1e-5
        up = loss()
        w[at] = old - 1e-5
        slope = (up - loss()) / 2e-5
        w[at] = old
        assert abs(slope - grads[k][at]) < 1e-5, k


def test_passages_cover_the_text():
    text = " ".join(f"w{i}" for i in range(350)) + "\n"
    assert "".join(quality.passages(text)) == text and len(quality.passages(text)) == 4
    assert quality.passages("") == [""] and len(quality.passages("x" * 100000)) == 1
    assert quality.passage_features(None).shape == (1, quality.N_FEATURES) and not quality.passage_features("").any()


def test_quality_of_odd_rows(spark, docs, labels):
    model = quality.train(docs, "doc_id", "text", labels, "doc_id", "quality")
    weights = model.attention("a good text " * 200)[1]
    assert abs(weights.sum() - 1) < 1e-9
    odd = spark.createDataFrame([(None, None, 3), (7, "", 4), (7, "", 4)], "doc_id long, text string, label int")
    out = quality.classify(odd, "doc_id", "text", labels.limit(0), "doc_id", "quality").collect()
    assert [(r.score, r.predicted) for r in out] == [(0.5, 1)] * 3
    twice = labels.union(labels).union(spark.createDataFrame([(None, 1, 0), (8, None, None)], labels.schema))
    assert quality.classify(odd, "doc_id", "text", twice, "doc_id", "quality").count() == 3
    assert quality.classify(docs.limit(0), "doc_id", "text", labels, "doc_id", "quality").count() == 0
