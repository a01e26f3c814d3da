"""Near-duplicate operators and fingerprints against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.llm import common
from gridseries.llm.common import connected_components, shingle_hashes, word_hashes
from gridseries.llm.embedding_dedup import embedding_links, shared_pivots, unit
from gridseries.llm.fingerprints import WeightedSampler, edited_text, fingerprint_edits, fingerprint_texts, likeness, text_fingerprint, to_text
from gridseries.llm.ngram_join import choose_bands, ngram_links, similar

SF = "/root/testdata/sf0.001"


def components(ids, pairs):
    near = {i: set() for i in ids}
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for i in sorted(ids):
        todo = [i] if i not in out else []
        while todo:
            v = todo.pop()
            if v not in out:
                out[v] = i
                todo += near[v]
    return {i: (len(near[i]), out[i]) for i in ids}


def ngrams(text):
    return set(shingle_hashes(word_hashes(text)).tolist())


def jaccard_links(texts, threshold=0.8):
    sets = {i: ngrams(t) for i, t in texts.items()}
    ids = sorted(i for i in sets if sets[i])
    pairs = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold]
    return components(list(texts), pairs)


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = choose_bands(threshold, 0.99, 128)
        assert bands * rows <= 128 and 1 - (1 - threshold**rows) ** bands >= 0.99
    with pytest.raises(ValueError):
        choose_bands(0.01, 0.999, 8)


def test_ngram_links_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    long = " ".join(f"w{i}" for i in range(4000))
    extra = [(1000, None), (1001, ""), (1002, "!!"), (1003, "one two"), (1004, "One  two."), (1005, "two one"), (1006, long), (1007, long + " end"), (1008, long.replace("w7 ", "x7 ", 1))]
    df = docs.union(spark.createDataFrame(extra, "doc_id long, text string"))
    df = df.withColumn("class", F.lit("x")).withColumn("node", F.lit(1)).withColumn("component", F.lit(None).cast("int"))
    out = {r.doc_id: (r.n_links, r.component_id) for r in ngram_links(df, "doc_id", "text").collect()}
    assert out == jaccard_links({r.doc_id: r.text for r in df.collect()})
    assert out[1003] == (1, 1003) and out[1000] == (0, 1000) and out[1006] == (2, 1006)


def test_a_group_larger_than_a_block_keeps_every_link(spark, monkeypatch):
    from gridseries.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 7)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[:40], f"own{i % 30}", *words[40:]])) for i in range(45)]  # 30 texts, 15 of them twice
    rows += [(100 + i, " ".join(words[: 30 + i])) for i in range(25)]  # a chain: each like its neighbours only
    out = {r.doc_id: (r.n_links, r.component_id) for r in ngram_links(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    want = jaccard_links(dict(rows))
    # banding finds a pair at the threshold with probability 0.995 and is allowed to miss it, never to add one
    assert sum(v[0] for v in out.values()) >= 0.99 * sum(v[0] for v in want.values())
    assert all(out[i][0] <= want[i][0] for i in want)


def test_ngram_links_of_odd_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")], "k long, t string")
    out = sorted((r.k is None, r.k or 0, r.n_links, r.component_id, r.kept) for r in ngram_links(df, "k", "t").collect())
    assert out == [(False, 1, 2, 1, True), (False, 1, 2, 1, True), (False, 2, 2, 1, False), (True, 0, 0, None, True), (True, 0, 0, None, True)]
    assert ngram_links(df.limit(0), "k", "t").count() == 0


def test_similar_compares_across_chunks_only():
    sets = [np.arange(10, dtype=np.uint64), np.arange(10, dtype=np.uint64) + np.uint64(1), np.arange(10, dtype=np.uint64)]
    assert similar(sets, np.array([True, True, True]), 0.8)[0].tolist() == [False, True, True]
    across = similar(sets, np.array([True, True, False]), 0.8)
    assert not across[0, 1] and across[0, 2] and across[2, 1]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300), (300, 301)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 300: 300, 301: 300}
    assert connected_components(df.limit(0)).count() == 0


def planted_vectors():
    rng = np.random.default_rng(11)
    base = rng.normal(size=(400, 64))
    near = [base[i] + rng.normal(size=64) * np.linalg.norm(base[i]) / 8 * s for i in range(60) for s in (0.1, 0.2, 0.3, 0.35)]
    hot = [base[0] + rng.normal(size=64) * 0.02 * np.linalg.norm(base[0]) for _ in range(300)]
    return np.concatenate([base, near, hot]).astype(np.float32)


def test_embedding_links_reach_brute_force(spark, monkeypatch):
    from gridseries.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 100)
    x = planted_vectors()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = {r.vec_id: r for r in embedding_links(df, "vec_id", "embedding").collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    want = linked.sum(axis=1)
    assert all(out[i].n_links <= want[i] for i in range(len(x)))
    assert sum(r.n_links for r in out.values()) >= 0.98 * want.sum()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.values())


def recall_of(spark, x, threshold=0.95):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(8)
    out = {r.vec_id: r.n_links for r in embedding_links(df, "vec_id", "embedding").collect()}
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    want = np.concatenate([(u[i : i + 1000] @ u.T >= threshold).sum(axis=1) - 1 for i in range(0, len(u), 1000)])
    assert all(out[i] <= want[i] for i in range(len(x)))
    return sum(out.values()) / want.sum()


@pytest.mark.parametrize(("share", "dims", "pivots"), [(0.0, 64, 1024), (0.7, 64, 256), (0.9, 64, 256), (0.0, 6, 256)])
def test_recall_on_planted_links_at_the_threshold(spark, monkeypatch, share, dims, pivots):
    """Pairs at cosine 0.952 among vectors that have a share of their length in common, or few dimensions."""
    from gridseries.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "LEAST_PIVOTS", pivots)
    rng = np.random.default_rng(4)
    n = 5000
    common = np.eye(dims)[0] * np.sqrt(share)
    draw = lambda m: (lambda z: z / np.linalg.norm(z, axis=1)[:, None])(np.c_[np.zeros(m) if share else rng.normal(size=m), rng.normal(size=(m, dims - 1))])
    x = common + np.sqrt(1 - share) * draw(n)
    a, aside = x[:1500], draw(1500)
    a = a / np.linalg.norm(a, axis=1)[:, None]
    aside -= (aside * a).sum(axis=1)[:, None] * a
    near = 0.952 * a + np.sqrt(1 - 0.952**2) * aside / np.linalg.norm(aside, axis=1)[:, None]
    assert recall_of(spark, np.concatenate([x, near])) >= 0.95


def test_vectors_of_every_length_are_compared(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(2200)]
    rows += [(3000 + i, rows[i][1]) for i in range(5)] + [(4000 + i, [1.0, 2.0 + i * 1e-4, 3.0]) for i in range(3)] + [(5000 + i, [2.0, 1.0]) for i in range(2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {r.vec_id: (r.n_links, r.component_id) for r in embedding_links(df, "vec_id", "embedding").collect()}
    assert [out[i] for i in (4000, 4001, 4002, 5000, 5001)] == [(2, 4000)] * 3 + [(1, 5000)] * 2
    assert all(out[3000 + i][1] <= i and out[3000 + i][0] >= 1 for i in range(5))


def test_vectors_without_a_direction_link_with_nothing(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (7, [1.0, float("nan"), 3.0]), (8, [float("inf"), 2.0, 3.0]), (9, v), (9, v), (None, v), (10, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vector", F.lit("x")).withColumn("pivot", F.lit(0))
    out = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embedding_links(df, "vec_id", "embedding").collect())
    assert out[0] == (0, 0, None, True)
    assert [x[:3] for x in out[1:]] == [(1, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 3, 1), (9, 3, 1), (10, 0, 10)]
    assert embedding_links(df.limit(0), "vec_id", "embedding").count() == 0
    assert embedding_links(df.where("vec_id = 3"), "vec_id", "embedding").count() == 1


def test_unit_survives_extreme_values():
    assert np.allclose(unit(np.array([1e-300, 1e-300])), 2**-0.5) and np.allclose(unit(np.array([1e300, 0])), [1, 0])


def test_shared_pivot_counts():
    prefixes = np.array([[3, 1, 2], [3, 2, 9], [7, 3, 8]])
    count, lower = shared_pivots(prefixes, 3)
    assert (count[0, 1], count[0, 2], count[1, 2]) == (2, 1, 1) and lower[0, 1] and not lower[0, 2]


def generalised_jaccard(a, b):
    a, b = (Counter(shingle_hashes(word_hashes(t)).tolist()) for t in (a, b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collisions_follow_the_generalised_jaccard_similarity():
    sampler = WeightedSampler(samples=2000, term_bits=10)
    shift = np.uint64(54)
    a = np.repeat(np.arange(40, dtype=np.uint64), [1 + i % 4 for i in range(40)]) << shift
    b = np.repeat(np.arange(10, 50, dtype=np.uint64), [1 + i % 3 for i in range(40)]) << shift
    x, y = Counter(a.tolist()), Counter(b.tolist())
    want = sum((x & y).values()) / sum((x | y).values())
    assert abs((sampler.fingerprint(a) == sampler.fingerprint(b)).mean() - want) < 0.04
    assert (sampler.fingerprint(a) == sampler.fingerprint(a[::-1].copy())).all()


@pytest.mark.parametrize("n", [100_000, 500_000])
def test_likeness_of_very_long_texts(n):
    rng, near, far = np.random.default_rng(n), [], []
    like = lambda *sets: likeness(*(to_text(sampler.fingerprint(x)) for x in sets))
    sampler = WeightedSampler()
    for _ in range(6):
        a = rng.integers(0, 1 << 64, n, np.uint64)
        b = np.concatenate([a[: n * 3 // 4], rng.integers(0, 1 << 64, n // 4, np.uint64)])  # 0.75 n of 1.25 n terms
        near.append(like(a, b))
        far.append(like(a, rng.integers(0, 1 << 64, n, np.uint64)))
    assert abs(np.mean(near) - 0.6) < 0.06 and np.mean(far) < 0.01
    # weights of 1 and 2: half of the terms count twice in one text only, 1.0 n of 1.5 n
    twice = [like(a, np.concatenate([a, a[: n // 2]])) for a in (rng.integers(0, 1 << 64, n, np.uint64) for _ in range(3))]
    assert abs(np.mean(twice) - 2 / 3) < 0.09


def test_terms_that_share_their_draws_stay_apart():
    sampler = WeightedSampler()
    a, b = (np.array([(5 << 39) + i], np.uint64) for i in (1, 2))
    assert not (sampler.fingerprint(a) == sampler.fingerprint(b)).any()
    both = sampler.fingerprint(np.concatenate([b, a]))
    assert (both == sampler.fingerprint(a)).all()
    assert ((sampler.fingerprint(np.concatenate([a, b, b])) == sampler.fingerprint(np.concatenate([b, b]))) | (sampler.fingerprint(np.concatenate([a, b, b])) == sampler.fingerprint(a))).all()


@pytest.mark.parametrize("rows_per_block", [10_000, 17])
def test_fingerprints_edits_and_followers(spark, monkeypatch, rows_per_block):
    from gridseries.llm import fingerprints

    monkeypatch.setattr(fingerprints.blocks_with_next, "__defaults__", (rows_per_block,))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = [(1000, None), (1001, ""), (1002, "éé"), (1003, "a b c d e"), (1004, "日" * 9000), (1005, "x " * 30000)]
    df = docs.union(spark.createDataFrame(odd, "doc_id long, text string")).withColumn("k", F.lit("clash")).withColumn("copy", F.lit(1))
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    order = sorted(texts)
    out = {r.doc_id: r for r in fingerprint_edits(df, "doc_id", "text").collect()}
    assert sorted(out) == order
    prints, errors = {}, []
    for i, d in enumerate(order):
        text, following = texts[d], texts[order[(i + 1) % len(order)]]
        edited = edited_text(text, following)
        assert len(edited) == len(text) - len(text) // 4 + min(len(text) // 4, len(following))
        r = out[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.edited_fingerprint == text_fingerprint(edited) and prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert r.near_next == likeness(r.fingerprint, text_fingerprint(following))
        if ngrams(text):
            errors.append(r.near_edited - generalised_jaccard(text, edited))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_fingerprint_order_with_null_and_repeated_keys(spark):
    rows = [(None, "n b"), (1, "b"), (1, "a"), (None, "n a"), (2, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = fingerprint_edits(df, "doc_id", "text").collect()
    follow = {"n a": "n b", "n b": "a", "a": "b", "b": "c", "c": "n a"}
    want = sorted(hashlib.sha256(edited_text(t, f).encode()).hexdigest() for t, f in follow.items())
    assert sorted(r.edited_sha256 for r in out) == want
    one = fingerprint_edits(df.where("doc_id = 2"), "doc_id", "text").collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprint_edits(df.limit(0), "doc_id", "text").count() == 0
    assert fingerprint_texts(df, "doc_id", "text").count() == 5


def test_shingles_of_short_texts():
    assert len(shingle_hashes(word_hashes(""))) == 0 and len(shingle_hashes(word_hashes("a b"))) == 1
    assert shingle_hashes(word_hashes("a b"))[0] != shingle_hashes(word_hashes("b a"))[0]
    assert len(shingle_hashes(word_hashes("a b c d e f"))) == 2
    assert common.word_hashes("Ab, aB") [0] == common.word_hashes("ab")[0]


def test_dense_places_are_found_and_links_inside_need_no_list():
    from gridseries.llm.embedding_dedup import dense_centres

    rng = np.random.default_rng(0)
    base = rng.normal(size=(2, 64))
    sample = np.concatenate([rng.normal(size=(200, 64)), *(b + rng.normal(size=(60, 64)) * 0.1 for b in base)])
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    centres = dense_centres(sample, 0.95)
    assert len(centres) == 2
    inside = sample[200:260]
    near = inside[(inside @ centres.T >= np.cos(np.arccos(0.95) / 2)).any(axis=1)]
    assert len(near) > 55 and (near @ near.T).min() >= 0.95
    assert len(dense_centres(sample[:200], 0.95)) == 0 and len(dense_centres(sample[:0], 0.95)) == 0


def test_a_text_near_the_centre_is_linked_without_a_comparison(spark, monkeypatch):
    from gridseries.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 10)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[: 3 * i], f"own{i}", *words[3 * i + 1 :]])) for i in range(60)]  # one word differs: all are links
    rows += [(100 + i, " ".join(words[: 168 + i])) for i in range(12)]  # shortened: some pairs are links
    compared = []
    plain = ngram_join.in_blocks

    def counting(members, *args):
        compared.append(members.where("core").count())
        return plain(members, *args)

    monkeypatch.setattr(ngram_join, "in_blocks", counting)
    out = {r.doc_id: (r.n_links, r.component_id) for r in ngram_links(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert out == jaccard_links(dict(rows))
    assert compared[0] >= 50
