"""BPE and packing against the tokenizer libraries and direct checks."""

import base64
import functools
import gc
import hashlib
import random
import weakref
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridseries.llm import common, language_id, packing, quality
from gridseries.llm.bpe import BytePairEncoder, encode_texts, text_encoder

RANKS, TOKENIZER = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = ["", None, " ", "\n\n  x", "it's we'LL 'tis", "a\x1cb c​d　", "é —. €!", "<|endoftext|>x<|endoftext|>", "日本語 テキスト", "_a_1_²", "x" * 5000, "ab " * 3000, "🙂🙃" * 50]


SPACES = "\t\n\r \x85\xa0\u1680\u2000\u2009\u2028\u202f\u205f\u3000"


@functools.cache
def whole_library() -> Tokenizer:
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def test_bpe_of_texts_equals_tiktoken_and_decodes(spark, reference):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None if i == 3 else 10**6 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    df = docs.union(odd).withColumn("n_tokens", F.lit("clash"))
    texts = sorted((r.text or "") for r in df.collect())
    out = encode_texts(df, "doc_id", "text", RANKS, P.PATTERN).collect()
    want = []
    for t in texts:
        ids = np.array(reference.encode_ordinary(t), "<u4")
        want.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == sorted(want)
    assert encode_texts(df.limit(0), "doc_id", "text", RANKS, P.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("ab '_\n\t .,1é")), max_size=40))
def test_any_text_equals_both_libraries(text):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))} if not hasattr(test_any_text_equals_both_libraries, "t") else None
    if ranks:
        test_any_text_equals_both_libraries.t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        test_any_text_equals_both_libraries.l = Tokenizer.from_file(TOKENIZER)
    ids = np.frombuffer(text_encoder(RANKS, P.PATTERN).encode(text), "<u4").tolist()
    assert ids == test_any_text_equals_both_libraries.t.encode_ordinary(text)
    mine = np.frombuffer(packing.text_tokenizer(TOKENIZER).encode(text), "<u4").tolist()
    assert mine == test_any_text_equals_both_libraries.l.encode(text, add_special_tokens=False).ids


def test_a_word_beside_marks_goes_through_the_library_once(library):
    texts = ["abide (abide) [abide]", '"abide", abide: x.abide/abide', "été! (été) l'été"]
    mine = packing.TextTokenizer(TOKENIZER)
    assert [x.tolist() for x in mine.encode_all(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert {c.strip("'") for c in mine.cache if "abide" in c or "été" in c} == {" abide", "abide", "été"}
    assert [x.tolist() for x in mine.encode_all([])] == [] and mine.encode_all([""])[0].tolist() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(SPACES + "aZ09é×ƻɏɐЖ日、²…'s.,(_-!\x00\x1c\xad"), max_size=20), max_size=6))
def test_texts_cut_at_any_white_space_equal_the_library(texts):
    mine, library = packing.text_tokenizer(TOKENIZER).encode_all(texts), whole_library()
    assert [x.tolist() for x in mine] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def merge_all(piece: bytes, tokens: list[bytes]) -> list[int]:
    ids, parts = {t: i for i, t in enumerate(tokens)}, [bytes([b]) for b in piece]
    while True:
        pairs = [ids.get(a + b, 10**9) for a, b in zip(parts, parts[1:])]
        if not pairs or min(pairs) == 10**9:
            return [ids[p] for p in parts]
        j = pairs.index(min(pairs))
        parts[j : j + 2] = [parts[j] + parts[j + 1]]


def train_merges(text: bytes, n: int) -> list[bytes]:
    """Tokens of a byte-level vocabulary, the most frequent pair of ``text`` first."""
    tokens, parts = [bytes([b]) for b in range(256)], [bytes([b]) for b in text]
    for _ in range(n):
        pairs = Counter(zip(parts, parts[1:]))
        (a, b), _ = max(((p, c) for p, c in pairs.items() if p[0] + p[1] not in tokens), key=lambda x: (x[1], x[0]))
        tokens.append(a + b)
        joined, i = [], 0
        while i < len(parts):
            both = parts[i : i + 2] == [a, b]
            joined.append(a + b if both else parts[i])
            i += 1 + both
        parts = joined
    return tokens


def test_backtracking_equals_merges_for_random_vocabularies():
    rng = random.Random(5)
    for _ in range(30):
        tokens = train_merges(bytes(rng.choices(b"abc", [5, 3, 1], k=600)), 40)
        bpe = BytePairEncoder(tokens)
        for _ in range(200):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 30)))
            want = [tokens.index(piece)] if piece in tokens else merge_all(piece, tokens)
            assert bpe.encode(piece) == want


def test_best_fit_places_every_item_once():
    rng = np.random.default_rng(3)
    for sizes in (rng.integers(1, 1024, 3000), np.full(50, 600), np.full(64, 16), np.array([1024, 1, 1023]), np.array([], np.int64)):
        where, offset, fill = packing.best_fit(sizes.astype(np.int64), 1024)
        for b in range(len(fill)):
            mine = sorted(zip(offset[where == b], sizes[where == b]))
            assert [o for o, _ in mine] == np.cumsum([0, *[s for _, s in mine]])[:-1].tolist()
            assert sum(s for _, s in mine) == fill[b] <= 1024


def check_packed(rows, lengths, capacity):
    """Pieces cover their documents, sequences have no gap and no more than capacity."""
    bins, docs = {}, {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    for doc, n in lengths.items():
        assert sorted(docs[doc]) == [(i, s, k) for i, (s, k) in enumerate(packing.cut(n, capacity))]
    return len(bins)


def test_documents_are_packed_whole(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    df = docs.union(odd).withColumn("bin", F.lit(1)).withColumn("item", F.lit("x")).withColumn("length", F.lit(None).cast("long"))
    ids = {r.doc_id: np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4") for r in df.collect()}
    rows = packing.pack_documents(df, "doc_id", "text", TOKENIZER, 256).collect()
    n = check_packed(rows, {d: len(x) for d, x in ids.items()}, 256)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert n <= 1.02 * -(-sum(map(len, ids.values())) // 256) + 1
    assert packing.pack_documents(df.limit(0), "doc_id", "text", TOKENIZER, 256).count() == 0


@pytest.mark.parametrize("sizes", ["uniform", "same", "halves"])
def test_rounds_merge_underfull_bins(spark, sizes):
    rng = np.random.default_rng(1)
    lengths = {"uniform": rng.integers(1, 101, 600), "same": np.full(600, 60), "halves": np.full(600, 50)}[sizes].tolist()
    df = spark.createDataFrame([(i, 0, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long")
    rows = packing.pack(df, 100, items_per_task=40, nearly_full=2).collect()
    assert sorted(r.doc_id for r in rows) == list(range(600))
    n = check_packed(rows, {}, 100)
    one = len(packing.best_fit(np.array([x for x in lengths if x < 100]), 100)[2]) + lengths.count(100)
    assert n <= 1.06 * one + 1  # tasks of 40 items lose a little


def test_no_two_sequences_of_many_tasks_can_merge(spark):
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 1024, 20_000), rng.integers(300, 700, 20_000), np.where(rng.random(20_000) < 0.5, 1, 520)):
        df = spark.range(0, 0).selectExpr("id AS doc_id", "id AS length").union(spark.createDataFrame([(i, n) for i, n in enumerate(lengths.tolist())], "doc_id long, length long"))
        fills = packing.pack(df, 1024, items_per_task=2_000).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
        assert sum(r.n for r in fills) == lengths.sum() and all(r.n == r.end <= 1024 for r in fills)
        open_ = sorted(r.n for r in fills if r.n < 1024 - packing.NEARLY_FULL)
        assert len(open_) < 2 or open_[0] + open_[1] > 1024
        assert len(fills) <= 1.011 * len(packing.best_fit(lengths.astype(np.int64), 1024)[2]) + 1


def test_repeated_and_null_keys_are_all_packed(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (1, "x y"), (1, "x y")], "doc_id long, text string")
    rows = packing.pack_documents(df, "doc_id", "text", TOKENIZER, 64).collect()
    assert len(rows) == 4 and len({(r.sequence_id, r.offset) for r in rows}) == 4 and len({r.sequence_id for r in rows}) == 1


@pytest.mark.parametrize("other", [language_id.predictor, quality.scorer])
def test_a_worker_drops_the_tokenizer_when_another_operator_runs(spark, other):
    kept = weakref.ref(packing.text_tokenizer(TOKENIZER))
    assert packing.text_tokenizer(TOKENIZER) is kept()
    assert len(list(other(None).func(iter([pd.Series(["a b", None])])))) == 1
    gc.collect()
    assert kept() is None
    kept = weakref.ref(packing.text_tokenizer(TOKENIZER))
    common.word_hashes("a b")
    gc.collect()
    assert kept() is None
