"""Best-fit packing of tokenised documents by hierarchical residual rounds.

Texts become token pieces of at most ``capacity``; a full piece is a sequence of
its own. Shorter pieces are dealt evenly to tasks, which best-fit them by falling
size and emit the nearly full bins. The underfull bins are the items of the next
round, on at most half the tasks, until no two of them can merge.
"""

from __future__ import annotations

import codecs
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from gridseries.llm.common import WHITE_SPACE, give_back, staged, worker_state

CACHED_CHUNKS = 400_000
CACHED_CHARS = 64
PLAIN_WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
SPACE, WORD, MARK, APOSTROPHE, LEAD = 1, 2, 3, 4, 5
CHARS_AT_ONCE = 4_000_000
KEPT_TEXTS = 50_000
ITEMS_PER_TASK = 200_000
NEARLY_FULL = 8


def _byte_kinds() -> np.ndarray:
    """SPACE, WORD, MARK or APOSTROPHE of an ASCII byte; LEAD of one that may start a space or a Latin letter of more bytes, else 0."""
    kinds = np.zeros(256, np.uint8)
    for b in range(33, 127):
        kinds[b] = WORD if chr(b).isalnum() else MARK
    kinds[ord("'")] = APOSTROPHE
    kinds[[ord(c) for c in "\t\n\v\f\r "]] = SPACE
    kinds[[0xC2, *range(0xC3, 0xCA), 0xE1, 0xE2, 0xE3]] = LEAD
    return kinds


def _byte_level() -> str:
    """The character that byte-level tokens have for each byte: its own if that is printable, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return "".join(chr(b) if b in own else chr(0x100 + others.index(b)) for b in range(256))


BYTE_LEVEL = _byte_level()
BYTE_KINDS = _byte_kinds()
#: by kind of a byte * 8 + kind of the next: a chunk ends between them (1), a white-space run does (2)
EDGES = np.zeros(64, np.uint8)
EDGES[[k * 8 + SPACE for k in range(5) if k != SPACE] + [WORD * 8 + MARK, WORD * 8 + APOSTROPHE, MARK * 8 + WORD]] = 1
EDGES[[SPACE * 8 + k for k in range(5) if k != SPACE]] = 2
SPACES = sorted(int.from_bytes(c.encode().ljust(3, b"\0")) for c in re.findall(f"[{WHITE_SPACE}]", "".join(map(chr, range(0x80, 0x3001)))))


def chunk_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chunks of UTF-8 texts begin; the texts, end to end in ``data``, begin at ``starts``.

    Cuts are where the byte-level pattern never matches across, and matches the same without what follows: before
    a white-space run and its last character, after the latter unless it is a space that a token may begin
    with, between a letter or digit and an ASCII mark, and between a mark that starts no contraction and a letter or digit.
    """
    kinds = BYTE_KINDS[data]
    if len(leads := np.flatnonzero(kinds == LEAD)):
        kinds[leads] = 0
        padded = np.append(data, np.zeros(2, np.uint8))
        lead, second, third = (padded[leads + i].astype(np.int64) for i in range(3))
        wide = lead >= 0xE1
        code = (lead << 16) + (second << 8) + np.where(wide, third, 0)
        point = ((lead & 0x1F) << 6) + (second & 0x3F)
        latin = ~wide & (point >= 0xC0) & (point < 0x250) & (point != 0xD7) & (point != 0xF7)
        for chars, size, kind in ((leads[latin], 2, WORD), (leads[np.isin(code, SPACES)], 3, SPACE)):
            for i in range(size):
                at = chars + i
                if i == 2:
                    at = at[data[chars] >= 0xE1]
                kinds[at] = kind
    edges = EDGES[kinds[:-1] * 8 + kinds[1:]]
    is_start = np.zeros(len(data) + 1, bool)
    is_start[starts] = True
    ends = np.flatnonzero(edges == 2) + 1
    ends = ends[~is_start[ends]]
    last = ends - 1
    for _ in range(2):  # back to the first byte
        last -= (data[last] & 0xC0) == 0x80
    is_start[1:-1] |= edges == 1
    is_start[last] = True
    is_start[ends[data[last] != ord(" ")]] = True
    return np.flatnonzero(is_start[:-1])


class TextTokenizer:
    """Whole texts to ids by the tokenizers library.

    Texts are cut into chunks (``chunk_starts``) and each distinct short chunk goes through
    the library once. A text that holds an added token's string goes through it whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        single = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_feed = single[0] if len(single) == 1 else None
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.words = self._word_tokenizer(path)

    def _word_tokenizer(self, path: str) -> Tokenizer | None:
        """The same model for plain words, each of which is one match of the byte-level pattern, in the byte-level alphabet."""
        steps = json.loads(self.tokenizer.to_str())
        if (steps.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or steps.get("normalizer"):
            return None
        words = Tokenizer.from_file(path)
        words.pre_tokenizer = pre_tokenizers.Sequence([])
        return words

    def _library(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in coded]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Each chunk's ids, from one call: a chunk has no line feed, so line feeds part them without changing any."""
        if self.line_feed is None:
            return self._library(chunks)
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(chunks)], add_special_tokens=False)[0].ids, "<u4")
        edges = np.flatnonzero(ids == self.line_feed)
        coded, edges = ids.tobytes(), [-1, *edges.tolist(), len(ids)]
        return [coded[4 * a + 4 : 4 * b] for a, b in zip(edges, edges[1:], strict=False)]

    def _plain(self, chunks: list[str]) -> list[bytes]:
        """Each plain word's ids, from one call for all of them as words of one text."""
        spelled = codecs.charmap_decode("\n".join(chunks).encode(), "strict", BYTE_LEVEL)[0].split(BYTE_LEVEL[ord("\n")])
        coded = self.words.encode_batch([spelled], is_pretokenized=True, add_special_tokens=False)[0]  # the fast one leaves word_ids empty
        edges = np.searchsorted(np.array(coded.word_ids), np.arange(len(chunks) + 1)).tolist()
        ids = np.array(coded.ids, "<u4").tobytes()
        return [ids[4 * a : 4 * b] for a, b in zip(edges, edges[1:], strict=False)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0].tobytes()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Chunks are cut and numbered as one Arrow array, so each distinct one is looked up once."""
        whole = {i: self._library([t])[0] for i, t in enumerate(texts) if self.added and self.added.search(t)}
        coded = [b"" if i in whole else t.encode() for i, t in enumerate(texts)]
        joined = b"".join(coded)
        text_ends = np.cumsum([0, *map(len, coded)])
        del coded
        starts = chunk_starts(np.frombuffer(joined, np.uint8), text_ends[:-1])
        counts = np.searchsorted(starts, text_ends)
        offsets = pa.py_buffer(np.append(starts, len(joined)))
        chunks = pa.LargeStringArray.from_buffers(len(starts), offsets, pa.py_buffer(joined)).dictionary_encode()
        distinct, numbers = chunks.dictionary.to_numpy(zero_copy_only=False).tolist(), chunks.indices.to_numpy()
        parts = list(map(self.cache.get, distinct))
        if None in parts:
            coded = self._unseen([c for c, p in zip(distinct, parts, strict=True) if p is None])
            parts = [coded[c] if p is None else p for c, p in zip(distinct, parts, strict=True)]
        flat = np.frombuffer(b"".join(parts), "<u4")
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        starts, sizes = (np.cumsum(sizes) - sizes)[numbers], sizes[numbers]
        ends = np.cumsum(sizes)
        ids = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]
        edges = np.concatenate([[0], ends])[counts]
        return [np.frombuffer(whole[i], "<u4") if i in whole else ids[edges[i] : edges[i + 1]] for i in range(len(texts))]

    def _unseen(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks that the cache lacks. A full cache becomes the older one, whose chunks come back when they are met."""
        older = self.older
        coded = {c: older[c] for c in chunks if c in older}
        new = [c for c in chunks if c not in coded]
        plain = [c for c in new if PLAIN_WORD.fullmatch(c)] if self.words else []
        if plain:
            coded.update(zip(plain, self._plain(plain), strict=True))
            new = [c for c in new if c not in coded]
        if blank := [c for c in new if c.isspace()]:
            coded.update(zip(blank, self._library(blank), strict=True))
            new = [c for c in new if c not in coded]
        if new:
            coded.update(zip(new, self._chunks(new), strict=True))
        if len(self.cache) + len(coded) > CACHED_CHUNKS:
            self.cache, self.older = {}, self.cache
        self.cache.update((c, p) for c, p in coded.items() if len(c) <= CACHED_CHARS)
        return coded


def text_tokenizer(path: str) -> TextTokenizer:
    """The Python worker's tokenizer for a file, built once."""
    kept = worker_state("packing", dict)
    if path not in kept:
        kept[path] = TextTokenizer(path)
    return kept[path]


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first, which holds the remainder."""
    first = n_ids % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, n_ids, capacity))]


class PieceMaker:
    """Rows (piece, start, length, crc32) of texts; the rows of texts met lately are kept by a digest of the text."""

    def __init__(self, path: str, capacity: int, end_id: int):
        self.tokenizer, self.capacity = text_tokenizer(path), capacity
        self.end = np.array([end_id], "<u4")
        self.kept: dict[bytes, list[tuple]] = {}

    def rows(self, texts: pa.Array) -> Iterator[list[tuple]]:
        digests = [xxhash.xxh3_128_digest(t.as_buffer() or b"") if t.is_valid else b"" for t in texts]
        at = 0
        while at < len(digests):
            held, group, chars = {}, [], 0
            start = at
            while at < len(digests) and chars < CHARS_AT_ONCE:
                key = digests[at]
                if key not in self.kept and key not in held:
                    text = texts[at].as_py() or ""
                    held[key] = len(group)
                    group.append(text)
                    chars += len(text)
                at += 1
            made = [self._rows(np.append(ids, self.end).tobytes()) for ids in self.tokenizer.encode_all(group)]
            for key in digests[start:at]:
                yield made[held[key]] if key in held else self.kept[key]
            give_back()
            if len(self.kept) > KEPT_TEXTS:
                self.kept = {}
            self.kept.update((key, made[i]) for key, i in held.items())

    def _rows(self, ids: bytes) -> list[tuple]:
        return [(piece, a, n, zlib.crc32(ids[4 * a : 4 * (a + n)])) for piece, (a, n) in enumerate(cut(len(ids) // 4, self.capacity))]


def token_pieces(df: DataFrame, key: str, text: str, tokenizer_path: str, capacity: int, end_id: int) -> DataFrame:
    """(doc, piece, start, length, ids_crc32) of every text's ids, followed by ``end_id``; null counts as empty."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        setting = tokenizer_path, capacity, end_id
        kept = worker_state("packing", dict)
        maker = kept.get(setting) or kept.setdefault(setting, PieceMaker(*setting))
        for batch in batches:
            rows = [(at, *row) for at, pieces in enumerate(maker.rows(batch.column(1))) for row in pieces]
            at, *numbers = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(numbers, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "piece", "start", "length", "ids_crc32"])

    return df.select(F.col(key).alias("doc"), F.col(text).alias("text")).mapInArrow(
        run, f"doc {kind}, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each item's bin and offset, and each bin's fill.

    ``open_at[g]`` stacks the bins with room ``g``; one integer has bit g set where
    that stack holds a bin, so the tightest room that fits is one shift away.
    """
    order = np.argsort(-sizes, kind="stable")
    where, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills = 0, []
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = open_at[room].pop()
            if not open_at[room]:
                rooms ^= 1 << room
        else:
            room, bin_ = capacity, len(fills)
            fills.append(0)
        where[i], offset[i] = bin_, capacity - room
        fills[bin_] = capacity - room + size
        if size < room:
            if not open_at[room - size]:
                rooms |= 1 << room - size
            open_at[room - size].append(bin_)
    return where, offset, np.array(fills, np.int64)


def _round(items: DataFrame, tasks: int, capacity: int, number: int) -> DataFrame:
    """Best-fit each task's items (item, size): (item, bin, shift, fill of the bin)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not parts:
            return
        item, size = (np.concatenate(p) for p in zip(*parts, strict=True))
        where, shift, fill = best_fit(size, capacity)
        bins = where + (number << 56) + (TaskContext.get().partitionId() << 32)
        for i in range(0, len(item), 10_000):
            s = slice(i, i + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (item[s], bins[s], shift[s], fill[where[s]])], names=["item", "bin", "shift", "fill"])

    return items.repartition(tasks).mapInArrow(run, "item long, bin long, shift long, fill long")


def _mergeable(bins: DataFrame, capacity: int) -> DataFrame | None:
    """The bins (item, size) that a next round can use; None if no two of them can merge.

    Those at most half full, and of every other size that leaves room for the least of
    them as many as there are of those: taken by their number within their task of the round
    before, so no window holds more than one task's bins.
    """
    half = F.col("size") <= capacity // 2
    n_half, least = bins.where(half).agg(F.count(F.lit(1)), F.min("size")).first()
    if not n_half:
        return None
    rank = F.row_number().over(Window.partitionBy("size", F.shiftright("item", 32)).orderBy("item"))
    ranked = bins.where(~half & (F.col("size") <= capacity - least)).withColumn("rank", rank)
    upto = F.sum("n").over(Window.partitionBy("size").orderBy("rank"))
    taken = ranked.groupBy("size", "rank").agg(F.count(F.lit(1)).alias("n")).withColumn("before", upto - F.col("n")).where(F.col("before") < n_half)
    return staged(bins.where(half).union(ranked.join(taken, ["size", "rank"], "left_semi").select("item", "size")), "pack-mergeable")


def pack(pieces: DataFrame, capacity: int, items_per_task: int = ITEMS_PER_TASK, nearly_full: int = NEARLY_FULL) -> DataFrame:
    """Add (sequence_id, offset) to rows with a ``length`` from 1 to ``capacity``.

    Every row gets one place; places in a sequence are gapless from 0. A bin with
    room for at most ``nearly_full`` is emitted at once, the others are merged as
    items in next rounds. Best fit leaves a task at most one bin that is
    half full or less, and two bins can only merge if one of them is: a round
    takes those and, of each fill that some of them go into, as many bins as there are of
    them (more could not be used). Rounds have at most half the tasks of the one before and end
    after the one that ran on a single task, or when no bin is half full or less.
    Only numbers move: the rows stay where they are until the join on their bin.
    """
    rows = staged(pieces.withColumn("item", F.monotonically_increasing_id()), "pack-pieces")
    small = rows.where(F.col("length") < capacity)
    items, links, number = small.select("item", F.col("length").cast("long").alias("size")), None, 0
    tasks = max(1, -(-items.count() // items_per_task))
    while True:
        placed = staged(_round(items, tasks, capacity, number), f"pack-round{number}")
        if links is None:
            links = placed
        else:  # items of earlier rounds follow the bin that they are in
            moved = placed.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("shift").alias("by"), F.col("fill").alias("filled"))
            links = links.join(moved, "bin", "left").select(
                "item",
                F.coalesce("to", "bin").alias("bin"),
                (F.col("shift") + F.coalesce("by", F.lit(0))).alias("shift"),
                F.coalesce("filled", "fill").alias("fill"),
            )
        if tasks == 1:
            break
        # bins left out of this round were more than its half full ones, and so than the next one's
        bins = placed.where(F.col("fill") < capacity - nearly_full).groupBy("bin").agg(F.max("fill").alias("size"))
        items = _mergeable(staged(bins.select(F.col("bin").alias("item"), "size"), "pack-bins"), capacity)
        if items is None:
            break
        tasks, number = min(-(-items.count() // items_per_task), tasks // 2), number + 1
    packed = rows.join(links.drop("fill"), "item", "left")
    return packed.select(
        *[F.col(c) for c in pieces.columns],
        # a full piece is alone: its own id, kept apart from bin ids by the sign
        F.coalesce(F.col("bin"), -1 - F.col("item")).alias("sequence_id"),
        F.coalesce(F.col("shift"), F.lit(0)).cast("long").alias("offset"),
    )


def pack_documents(df: DataFrame, key: str, text: str, tokenizer_path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset): all texts in sequences of at most ``capacity`` ids.

    Null counts as an empty text, whose only id is ``end_id``; keys may be null or
    repeat, each row is packed. An empty table gives an empty result.
    """
    return pack(token_pieces(df, key, text, tokenizer_path, capacity, end_id), capacity).withColumnRenamed("doc", key)
