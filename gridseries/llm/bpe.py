"""Byte-level BPE encoding and decoding by backtracking over an Aho-Corasick match.

Bytes are mapped to Latin-1 characters so that an automaton over strings matches
byte tokens. From the longest token at each place the encoder walks right, takes a
shorter token when the pair with the previous one could not have come out of the
merges, and steps back when none is left. A place that failed is never tried
again, so a piece costs linear time, and the memoised pair test makes the
result equal to the exact merges by rank.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gridseries.llm.common import CHUNKS

MEMO = 1_000_000
CACHED_CHUNKS = 500_000
CACHED_CHARS = 64


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file (base64 token, rank), by rank; ranks must run from 0."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


class BytePairEncoder:
    """Exact BPE of byte strings for a list of tokens whose index is id and merge rank."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens)}
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError("all 256 bytes must be tokens")
        self.left, self.right = list(range(len(tokens))), list(range(len(tokens)))
        self.automaton = ahocorasick.Automaton()
        self.shorter = [-1] * len(tokens)
        self._valid: dict[tuple[int, int], bool] = {}
        for i, token in enumerate(tokens):
            if len(token) > 1:
                parts = self._merge_below(token, i)
                if len(parts) != 2:  # no order of merges makes this token: only a piece equal to it has its id
                    continue
                self.left[i], self.right[i] = parts
            self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        for i, token in enumerate(tokens):
            for end in range(len(token) - 1, 0, -1):
                j = self.ids.get(token[:end])
                if j is not None and token[:end].decode("latin-1") in self.automaton:
                    self.shorter[i] = j
                    break

    def _merge_below(self, token: bytes, rank: int) -> list[int]:
        """Ids left when ``token`` is merged with the ranks below ``rank`` only."""
        parts = [token[j : j + 1] for j in range(len(token))]
        while len(parts) > 2:
            pairs = [self.ids.get(parts[j] + parts[j + 1], rank) for j in range(len(parts) - 1)]
            least = min(pairs)
            if least >= rank:
                break
            j = pairs.index(least)
            parts[j : j + 2] = [parts[j] + parts[j + 1]]
        return [self.ids[p] for p in parts]

    def can_follow(self, a: int, b: int) -> bool:
        """Whether the merges of a's and b's bytes together end in just (a, b).

        Undoes the later of the two tokens' last merges, again and again: the pair
        is broken up if the parts that touch at the seam would have merged with
        each other before the merge that was undone.
        """
        key = (a, b)
        known = self._valid.get(key)
        if known is not None:
            return known
        ids, tokens = self.ids, self.tokens
        limit, good = len(tokens), True
        while True:
            if ids.get(tokens[a] + tokens[b], limit) < limit:
                good = False
                break
            if a > b:
                limit = a
                a = self.right[a]
                if a != limit:
                    continue
                limit = b + 1
                b = self.left[b]
                if b + 1 == limit:
                    break
            else:
                limit = b + 1
                b = self.left[b]
                if b + 1 != limit:
                    continue
                limit = a
                a = self.right[a]
                if a == limit:
                    break
        if len(self._valid) >= MEMO:
            self._valid.clear()
        self._valid[key] = good
        return good

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece of text (one match of the token pattern)."""
        if piece in self.ids:
            return [self.ids[piece]]
        size = len(piece)
        longest = [0] * size
        for end, (token, length) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - length + 1] = token  # ends rise, so the last is the longest
        dead = bytearray(size + 1)
        tokens, shorter, can_follow, lengths = [], self.shorter, self.can_follow, self.tokens
        at, token = 0, longest[0]
        while at < size:
            end = at + len(lengths[token])
            if not dead[end] and (not tokens or can_follow(tokens[-1], token)):
                tokens.append(token)
                at = end
                if at < size:
                    token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[at] = 1
                token = tokens.pop()
                at -= len(lengths[token])
        return tokens


class TextEncoder:
    """Whole texts to ids and back; pieces are the pattern's matches, each merged separately."""

    def __init__(self, ranks_path: str, pattern: str):
        self.bpe = BytePairEncoder(read_ranks(ranks_path))
        self.pieces = regex.compile(pattern)
        self.cache: dict[str, bytes] = {}
        self.piece_cache: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        ids = np.array(self.bpe.encode(piece.encode()), "<u4").tobytes()
        return self._keep(self.piece_cache, piece, ids)

    def _chunk(self, chunk: str) -> bytes:
        known, piece = self.piece_cache.get, self._piece
        return self._keep(self.cache, chunk, b"".join([known(p) or piece(p) for p in self.pieces.findall(chunk)]))

    @staticmethod
    def _keep(cache: dict[str, bytes], text: str, ids: bytes) -> bytes:
        if len(text) <= CACHED_CHARS:
            if len(cache) >= CACHED_CHUNKS:
                cache.clear()
            cache[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, chunk = self.cache.get, self._chunk
        return b"".join([known(c) or chunk(c) for c in CHUNKS.findall(text)])

    def decode(self, ids: bytes) -> bytes:
        tokens = self.bpe.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def text_encoder(ranks_path: str, pattern: str) -> TextEncoder:
    """The Python worker's encoder for a rank file, built once."""
    if (ranks_path, pattern) not in _ENCODERS:
        _ENCODERS[ranks_path, pattern] = TextEncoder(ranks_path, pattern)
    return _ENCODERS[ranks_path, pattern]


def encode_texts(df: DataFrame, key: str, text: str, ranks_path: str, pattern: str, ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256[, ids]) of every row's whole text.

    The hashes are over the ids as little-endian unsigned 32-bit integers and over
    the bytes that the ids decode to; ``ids`` adds the ids. A null text counts
    as empty: no ids. Keys may be null or repeat; other columns are not read. No
    shuffle; the rank file must be at ``ranks_path`` on every executor.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(ranks_path, pattern)
        for batch in batches:
            out: list[tuple] = []
            for value in batch.column(1):
                coded = encoder.encode(value.as_py() or "")
                row = (len(coded) // 4, hashlib.sha256(coded).hexdigest(), hashlib.sha256(encoder.decode(coded)).hexdigest())
                out.append(row + (np.frombuffer(coded, "<u4").astype("i4"),) * ids)
            columns = list(zip(*out, strict=True)) or [()] * (3 + ids)
            types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=False))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = [key, "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 + ids]
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return df.select(key, text).mapInArrow(run, schema)
