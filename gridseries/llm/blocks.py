"""Documents in blocks, each with a dictionary of its own items (words, chunks of text).

A task cuts whole texts into items, gathers documents until a block is full, and gives out one row
per document with the codes of its items and one row with the block's distinct items. What is to be known of an item
over the whole corpus comes from joining the dictionaries, which are far smaller than the texts, and goes
back to the block, where a task reads the dictionary row first and then streams the documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ITEMS = 2_000_000
BYTES_AT_ONCE = 8_000_000
DICTIONARY, DOCUMENT = 0, 1


class Block(NamedTuple):
    """``rows`` are the documents without their texts; ``counts`` says how many of ``codes`` each has; codes point into ``items``, the most frequent first."""

    number: int
    rows: pa.Table
    counts: np.ndarray
    codes: np.ndarray
    items: pa.Array


def slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of at most ``most`` in all, or one larger row alone."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def code_blocks(batches: Iterator[pa.RecordBatch], text: str, split: Callable[[pa.Array], tuple[pa.Array, np.ndarray]], size: int = BLOCK_ITEMS) -> Iterator[Block]:
    """Blocks of a task's rows. ``split`` gives the items of all texts, in order, and how many each text has.

    A null text counts as empty; a row never straddles blocks. A block is closed when it holds ``size`` items, so it exceeds
    that by one slice of texts, or one long text, at most.
    """
    number, held, n = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text))
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        for part in slices(batch, lengths, BYTES_AT_ONCE):
            at = part.schema.get_field_index(text)
            items, counts = split(pc.fill_null(part.column(at), ""))
            held.append((pa.Table.from_batches([part]).remove_column(at), items, counts))
            n += len(items)
            if n >= size:
                yield _closed(number, held)
                number, held, n = number + 1, [], 0
    if held:
        yield _closed(number, held)


def _closed(number: int, held: list[tuple[pa.Table, pa.Array, np.ndarray]]) -> Block:
    coded = pa.chunked_array([items for _, items, _ in held], pa.string()).dictionary_encode().unify_dictionaries()
    codes = np.concatenate([np.empty(0, np.int32), *(c.indices.to_numpy() for c in coded.chunks)])
    items = coded.chunk(0).dictionary if coded.num_chunks else pa.array([], pa.string())
    order = np.argsort(-np.bincount(codes, minlength=len(items)), kind="stable")
    rank = np.empty(len(items), np.int32)
    rank[order] = np.arange(len(items), dtype=np.int32)
    return Block(number, pa.concat_tables([rows for rows, _, _ in held]), np.concatenate([c for _, _, c in held]), rank[codes], items.take(pa.array(order)))


def packed(codes: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Each count's run of codes as bytes of seven bits, the lowest first; all but a code's last one have the eighth bit set."""
    codes = codes.astype(np.uint32)
    size = 1 + (codes >= 1 << 7).astype(np.int64) + (codes >= 1 << 14) + (codes >= 1 << 21) + (codes >= 1 << 28)
    ends = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(ends[-1], np.uint8)
    for i in range(int(size.max(initial=0))):
        there = np.flatnonzero(size > i)
        more = (size[there] > i + 1).astype(np.uint8) << 7
        out[ends[there] + i] = ((codes[there] >> np.uint32(7 * i)) & np.uint32(127)).astype(np.uint8) | more
    edges = ends[np.concatenate([[0], np.cumsum(counts)])]
    return raw_binary(out, edges)


def raw_binary(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Binary values that lie between neighbouring byte positions of ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def unpacked(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All codes of packed values, in order, and how many each value has."""
    data = np.frombuffer(b"".join(values.to_pylist()), np.uint8)
    last = data < 128
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    codes = (data[starts] & 127).astype(np.int64)
    for i in range(1, 5):
        there = np.flatnonzero(ends - starts >= i)
        codes[there] |= (data[starts[there] + i] & 127).astype(np.int64) << (7 * i)
    before = np.concatenate([[0], np.cumsum(last)])
    edges = np.concatenate([[0], np.cumsum(pc.binary_length(values).to_numpy())])
    return codes, np.diff(before[edges])


def lists(flat: np.ndarray | pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Consecutive runs of ``flat`` as one list for each count."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), flat if isinstance(flat, pa.Array) else pa.array(flat))


def one_list(flat: np.ndarray | pa.Array) -> pa.ListArray:
    return lists(flat, np.array([len(flat)]))


def record(columns: dict[str, Any], schema: pa.Schema, rows: int) -> pa.RecordBatch:
    """A batch with these columns; the schema's others are null."""
    return pa.RecordBatch.from_arrays([pa.array([None] * rows, f.type) if f.name not in columns else columns[f.name].cast(f.type) for f in schema], schema=schema)


def reunite(documents: DataFrame, dictionaries: DataFrame) -> DataFrame:
    """Rows of both, by ``block``: each task meets the dictionary of a block just before its documents."""
    both = documents.withColumn("kind", F.lit(DOCUMENT)).unionByName(dictionaries.withColumn("kind", F.lit(DICTIONARY)), allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", "kind")


def by_block(batches: Iterator[pa.RecordBatch], read: Callable[[pa.RecordBatch], Any]) -> Iterator[tuple[Any, pa.RecordBatch]]:
    """What ``read`` makes of a block's dictionary row, with runs of the block's documents."""
    known = None
    for batch in batches:
        kinds = batch.column(batch.schema.get_field_index("kind")).to_numpy()
        at = np.flatnonzero(kinds == DICTIONARY)
        edges = np.unique(np.concatenate([[0], at, at + 1, [len(kinds)]]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            part = batch.slice(a, b - a)
            if kinds[a] == DICTIONARY:
                known = read(part)
            elif b > a:
                yield known, part
