"""Two tokenizers' tokens of the same texts, aligned by their bytes.

Neither tokenizer's tokens cross the place where a chunk of text ends (see CHUNK), so a block's distinct chunks are
coded and aligned once, as Arrow tables: flattened lists with parent indices, ends as cumulative sums that start
again in each chunk, Acero hash joins on (chunk, end), and grouped partial counts. Spark merges the counts of id pairs over
all blocks and returns them to the blocks; a document adds up its chunks.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridseries.llm.blocks import by_block, code_blocks, lists, one_list, packed, record, reunite, unpacked
from gridseries.llm.common import WHITE_SPACE, staged

_OTHER_SPACE = WHITE_SPACE.replace("\t-\r ", "\t\x0b\x0c\r")
#: A text is cut before a space or line feed that follows a character that is no white space. The byte-level pattern has no match
#: across that place, and no piece holds a line feed, or a space after another character (both are checked).
CHUNK = re.compile(rf"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+(?:[{_OTHER_SPACE}][{WHITE_SPACE}]*[^{WHITE_SPACE}]*)*|[{WHITE_SPACE}]+")
SPACE_MARK = "▁"
#: A block's chunks are held with their tokens as Python lists, so it is smaller than a block of words.
BLOCK_CHUNKS = 600_000
CODED_AT_ONCE = 20_000
HASHED_AT_ONCE = 100_000


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: itself where it is printable, else counted from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of every id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores already
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        state = json.loads(self.a.to_str())
        if state["pre_tokenizer"]["type"] != "ByteLevel" or state["pre_tokenizer"]["add_prefix_space"] or state["normalizer"]:
            raise ValueError("A must be a plain byte-level tokenizer")
        vocabulary, char = self.a.get_vocab(with_added_tokens=True), byte_of_character()
        names = {i: t for t, i in vocabulary.items()}
        special = {i: t.content for i, t in self.a.get_added_tokens_decoder().items()}
        self.bytes_a = pa.array([special[i].encode() if i in special else bytes(char[c] for c in names.get(i, "")) for i in range(max(names) + 1)], pa.binary())
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\n" in p or SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces) or SPACE_MARK not in pieces:
            raise ValueError("B's pieces must not cross spaces or line feeds")
        self.space = pieces.index(SPACE_MARK)
        self.bytes_b = pa.array([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)], pa.binary())

    def encode_a(self, chunks: list[str]) -> Iterator[list[int]]:
        for i in range(0, len(chunks), CODED_AT_ONCE):
            yield from (e.ids for e in self.a.encode_batch_fast(chunks[i : i + CODED_AT_ONCE], add_special_tokens=False))

    def encode_b(self, chunks: list[str]) -> Iterator[list[int]]:
        """B puts a space before what it encodes: it takes the place of the chunk's first one, or is dropped."""
        for i in range(0, len(chunks), CODED_AT_ONCE):
            part = chunks[i : i + CODED_AT_ONCE]
            coded = self.b.encode([c[1:] if c[0] == " " else c for c in part], num_threads=1)
            for chunk, ids in zip(part, coded, strict=True):
                yield [self.space] if chunk == " " else ids if chunk[0] == " " else ids[1:]


_TOKENIZERS: dict[tuple[str, str], Tokenizers] = {}


def tokenizers_of(path_a: str, path_b: str) -> Tokenizers:
    """The Python worker's pair, built once."""
    if (path_a, path_b) not in _TOKENIZERS:
        _TOKENIZERS[path_a, path_b] = Tokenizers(path_a, path_b)
    return _TOKENIZERS[path_a, path_b]


def split_chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The chunks of a space and each text, none for an empty text."""
    flat: list[str] = []
    counts = []
    for text in texts.to_pylist():
        before = len(flat)
        if text:
            flat += CHUNK.findall(" " + text)
        counts.append(len(flat) - before)
    return pa.array(flat, pa.string()), np.array(counts, np.int64)


class Aligned(NamedTuple):
    """For each chunk: whether both give back its bytes, its numbers, its groups as text; for each link its chunk and its pair of ids."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: pa.Array
    link_row: np.ndarray
    link_pair: np.ndarray
    pairs: np.ndarray


def _flat(ids: list[list[int]], token_bytes: pa.Array) -> pa.Table:
    """A row for each token: (row, id, end, at); ends count from 0 in each row."""
    column = pa.array(ids, pa.list_(pa.int32()))
    flat, row = column.flatten(), pc.list_parent_indices(column)
    ends = pc.cumulative_sum(pc.cast(pc.binary_length(pc.take(token_bytes, flat)), pa.int64())).to_numpy()
    rows = row.to_numpy()
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    before = np.where(first > 0, ends[first - 1], 0) if len(first) else first
    within = ends - np.repeat(before, np.diff(first, append=len(rows)))
    return pa.table({"row": rows, "id": flat, "end": within, "at": np.arange(len(rows))})


def _joined_bytes(ids: list[list[int]], token_bytes: pa.Array) -> pa.Array:
    column = pa.array(ids, pa.list_(pa.int32()))
    return pc.binary_join(lists(pc.take(token_bytes, column.flatten()), column.value_lengths().to_numpy()), b"")


def _group_texts(tokens: pa.Table, shared: np.ndarray) -> pa.Array:
    """The ids of each group, joined by commas. A group ends with a token whose end is shared."""
    last = np.flatnonzero(shared)
    return pc.binary_join(lists(pc.cast(tokens["id"].combine_chunks(), pa.string()), np.diff(last, prepend=-1)), ",")


def align(chunks: pa.Array, pair: Tokenizers) -> Aligned:
    """Both tokenizers' tokens of every chunk, cut into groups and linked."""
    words, n = chunks.to_pylist(), len(chunks)
    ids_a, ids_b = list(pair.encode_a(words)), list(pair.encode_b(words))
    raw = chunks.cast(pa.binary())
    good = pc.and_(pc.equal(_joined_bytes(ids_a, pair.bytes_a), raw), pc.equal(_joined_bytes(ids_b, pair.bytes_b), raw)).to_numpy(zero_copy_only=False)
    if not good.all():
        ids_a, ids_b = ([x if g else [] for x, g in zip(ids, good, strict=True)] for ids in (ids_a, ids_b))
    a, b = _flat(ids_a, pair.bytes_a), _flat(ids_b, pair.bytes_b)
    every = a.join(b, keys=["row", "end"], join_type="full outer", right_suffix="_b", use_threads=False).sort_by([("row", "ascending"), ("end", "ascending")])
    both = pc.and_(pc.is_valid(every["id"]), pc.is_valid(every["id_b"]))
    shared = every.filter(both)
    ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    ends_a[shared["at"].to_numpy()] = True
    ends_b[shared["at_b"].to_numpy()] = True
    groups = pc.binary_join_element_wise(_group_texts(a, ends_a), _group_texts(b, ends_b), "|")
    count = lambda rows: np.bincount(rows.to_numpy(), minlength=n)
    n_groups = count(shared["row"])
    # between two neighbouring ends lies one token of each side, a link; its tokens are the next ones that end
    next_a, next_b = (pc.fill_null_backward(every[c]).to_numpy().astype(np.int64) for c in ("id", "id_b"))
    pairs, link_pair = np.unique(next_a << 32 | next_b, return_inverse=True)
    return Aligned(good, count(a["row"]), count(b["row"]), n_groups, pc.binary_join(lists(groups, n_groups), ";"), every["row"].to_numpy().astype(np.int32), link_pair.astype(np.int32), pairs)


def _digest(codes: np.ndarray, groups: pa.Array) -> str:
    """SHA-256 of a text's groups, joined by ';', a run of chunks at a time."""
    out = hashlib.sha256()
    for i in range(0, len(codes), HASHED_AT_ONCE):
        out.update((";" * (i > 0) + ";".join(groups.take(pa.array(codes[i : i + HASHED_AT_ONCE])).to_pylist())).encode())
    return out.hexdigest()


def _aligned(docs: DataFrame, key: str, text: str, path_a: str, path_b: str) -> DataFrame:
    """Documents with their numbers and their chunks' codes, and the blocks' links and counts of id pairs."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"block long, key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, link_row array<int>, link_pair array<int>, pairs array<long>, times array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers_of(path_a, path_b)
        for block in code_blocks(batches, "text", split_chunks, BLOCK_CHUNKS):
            made, n = align(block.items, pair), block.rows.num_rows
            ends = np.cumsum(block.counts)
            doc = np.repeat(np.arange(n), block.counts)
            total = lambda values, doc=doc, block=block, n=n: np.bincount(doc, values[block.codes], n).astype(np.int64)
            # a chunk that either tokenizer does not give back takes the tokens of its whole text
            whole = total(~made.good) == 0
            kept = np.repeat(whole, block.counts)
            n_a, n_b, n_groups = (np.where(whole, total(x), 0) for x in (made.n_a, made.n_b, made.n_groups))
            shas = [_digest(block.codes[end - size : end], made.groups) if ok and size else "" for end, size, ok in zip(ends.tolist(), block.counts.tolist(), whole.tolist(), strict=True)]
            times = np.bincount(block.codes[kept], minlength=len(block.items))
            links = pa.table({"pair": made.link_pair, "times": times[made.link_row]}).group_by("pair", use_threads=False).aggregate([("times", "sum")]).sort_by("pair")
            types = [("block", pa.int64()), ("key", block.rows["key"].type), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("codes", pa.binary()), *((c, pa.list_(pa.int32())) for c in ("link_row", "link_pair")), *((c, pa.list_(pa.int64())) for c in ("pairs", "times"))]
            fields, number = pa.schema(types), lambda size, block=block: pa.array(np.full(size, block.number))
            found = {"block": number(1), "link_row": one_list(made.link_row), "link_pair": one_list(made.link_pair), "pairs": one_list(made.pairs), "times": one_list(links["times_sum"].combine_chunks())}
            yield record(found, fields, 1)
            numbers = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_a + n_b - n_groups}
            coded = {"block": number(n), "key": block.rows["key"].combine_chunks(), "groups_sha256": pa.array(shas), "codes": packed(block.codes[kept], np.where(whole, block.counts, 0))}
            yield record(coded | {c: pa.array(v) for c, v in numbers.items()}, fields, n)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


def _summed(documents: DataFrame, dictionaries: DataFrame, kind: str) -> DataFrame:
    """Per document the sums over its links of what the corpus says of their pairs."""

    def read(row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        flat = lambda c: row.column(row.schema.get_field_index(c)).flatten()
        known = flat("known")
        pair, count, best = (known.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        counts, bests = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
        counts[pair], bests[pair] = count, best
        rows, links = flat("link_row").to_numpy(), flat("link_pair").to_numpy()
        n = int(rows.max(initial=-1)) + 1
        sums = np.zeros(n, np.int64)
        np.add.at(sums, rows, counts[links])
        return sums, np.bincount(rows, bests[links], n).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for known, part in by_block(batches, read):
            get = lambda c, part=part: part.column(part.schema.get_field_index(c))
            flat, sizes = unpacked(get("codes"))
            edges = np.concatenate([[0], np.cumsum(sizes)])
            columns = [get(c) for c in ("key", "n_a", "n_b", "n_groups", "n_links")]
            for sums in known or (np.zeros(1, np.int64),) * 2:
                running = np.concatenate([[0], np.cumsum(sums[flat])])
                columns.insert(5, pa.array(running[edges[1:]] - running[edges[:-1]]))
            yield pa.RecordBatch.from_arrays([*columns, get("groups_sha256")], names=names)

    names = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return reunite(documents, dictionaries).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(block, pair, a, b, n): how often each id pair of a block is linked in it."""
    rows = aligned.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("pair", "p"))
    return rows.select("block", "pair", F.shiftright("p.pairs", 32).alias("a"), F.col("p.pairs").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), F.col("p.times").alias("n"))


def align_tokenizers(docs: DataFrame, key: str, text: str, path_a: str, path_b: str) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row's whole text.

    A codes a space and the text, B the text (it adds the space). Null and empty texts, and texts that either tokenizer does not
    give back byte by byte, have no tokens: zeros and an empty groups_sha256, and they count for no pair. Keys may be
    null or repeat, every row counts; a very long text is a block of its own, its chunks coded in runs; other columns are not
    read. An empty table gives an empty result.

    Texts are read once; their chunks travel once, as codes. A pair of ids has one row for each block at most, and the table of
    B's highest counts one row for each of B's ids, so it may be broadcast.
    """
    aligned = staged(_aligned(docs, key, text, path_a, path_b), "alignment")
    rows = pair_counts(aligned)
    counts = staged(rows.where("n > 0").groupBy("a", "b").agg(F.sum("n").alias("count")), "alignment-pairs")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    judged = counts.join(F.broadcast(highest), "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
    known = rows.where("n > 0").select("block", "pair", "a", "b").join(judged, ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("pair", "count", "best")).alias("known"))
    links = aligned.where("pairs IS NOT NULL").select("block", "link_row", "link_pair").join(known, "block", "left")
    documents = aligned.where("codes IS NOT NULL").select("block", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes")
    return _summed(documents, links, docs.schema[key].dataType.simpleString()).withColumnRenamed("key", key)
