"""Tokenizer alignment against whole-text calls of both libraries."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridseries.llm import alignment, blocks

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["", None, " ", "\n\n  x", "it's we'LL 'tis", "a\x1cb c​d　", "é —. €!", "<|endoftext|>x<|endoftext|>", "日本語 テキスト", "_a_1_²", "x" * 5000, "ab " * 3000, "🙂🙃" * 50, "a▁b", "<0x41> <s> </s>", "a \t\r\n b;\r\n", "x  y \n", "a ", "\n", "\t\t \t", " \n \n\n  ", "a\x00b", "  \x85x", "a ", "a "]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    char = alignment.byte_of_character()
    names = {i: bytes(char[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    return a, names, sentencepiece.SentencePieceProcessor(model_file=B)


def coded(text, libraries):
    """Ids and ends of both tokenizers over the whole text; None if either does not give the bytes back."""
    a, names, b = libraries
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw = [names[i] for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
    if any(b"".join(r) != (" " + text).encode() for r in raw):
        return None
    ends = [[sum(map(len, r[: i + 1])) for i in range(len(r))] if len(r) < 50 else list(__import__("itertools").accumulate(map(len, r))) for r in raw]
    return ids, ends


def expected(texts, libraries):
    rows = []
    for text in texts:
        found = coded(text, libraries) if text else None
        if not found:
            rows.append(None)
            continue
        (a, b), (ends_a, ends_b) = found
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(f"{','.join(map(str, a[i:k]))}|{','.join(map(str, b[j:m]))}")
            i, j = k, m
        links, i, j = [], 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            i, j = i + (ends_a[i] <= ends_b[j]), j + (ends_b[j] <= ends_a[i])
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(link for r in rows if r for link in r[3])
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    return [(*r[:3], len(r[3]), sum(count[x] == highest[x[1]] for x in r[3]), sum(count[x] for x in r[3]), r[4]) if r else (0, 0, 0, 0, 0, 0, "") for r in rows]


@pytest.mark.parametrize("size", [100, 600_000])
def test_documents_equal_the_libraries(spark, libraries, size, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None if i == 4 else 10**6 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    df = docs.union(odd).union(odd.limit(5)).withColumn("n_a", F.lit("clash")).withColumn("block", F.lit(1))
    texts = [r.text for r in df.collect()]
    monkeypatch.setattr(alignment, "BLOCK_CHUNKS", size)
    out = alignment.align_tokenizers(df, "doc_id", "text", A, B)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = out.collect()
    assert sorted(tuple(r)[1:] for r in rows) == sorted(expected(texts, libraries))
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in df.select("doc_id").collect())
    assert alignment.align_tokenizers(df.limit(0), "doc_id", "text", A, B).count() == 0


def test_codes_are_packed_and_unpacked():
    codes = np.array([0, 127, 128, 16383, 16384, 2097151, 2097152, 2**28, 2**31 - 1, 5])
    counts = np.array([0, 3, 0, 6, 1, 0])
    values = blocks.packed(codes, counts)
    flat, sizes = blocks.unpacked(values)
    assert flat.tolist() == codes.tolist() and sizes.tolist() == counts.tolist()
    assert [len(v) for v in values.to_pylist()] == [0, 4, 0, 22, 1, 0]
    assert [x.tolist() for x in blocks.unpacked(blocks.packed(codes[:0], counts[:1]))] == [[], [0]]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("ab ▁'_\n\t\r .,1é ")), min_size=1, max_size=40))
def test_chunks_of_any_text_equal_the_whole(text):
    pair = alignment.tokenizers_of(A, B)
    chunks = alignment.CHUNK.findall(" " + text)
    assert "".join(chunks) == " " + text
    assert [i for ids in pair.encode_a(chunks) for i in ids] == pair.a.encode(" " + text, add_special_tokens=False).ids
    if alignment.SPACE_MARK not in text:
        assert [i for ids in pair.encode_b(chunks) for i in ids] == pair.b.encode(text)
