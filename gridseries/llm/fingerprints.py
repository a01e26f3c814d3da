"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its runs of five words with their counts. For each
sample number, gamma-distributed draws that belong to a term and the term's weight
pick one (term, step) of the set; two texts pick the same with a probability
equal to the generalised Jaccard similarity sum(min) / sum(max) of their weights.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.llm.common import mix64, shingle_hashes, staged, word_hashes

SAMPLES = 128
#: A term's draws are the run of one table that starts at this many bits of its hash; they only order terms, the whole hash tells them apart.
TERM_BITS = 25
#: Terms whose draws are gathered at once.
TERMS_AT_ONCE = 256
PLACES_AT_ONCE = 1 << 19
ROWS_PER_BLOCK = 10_000


def _uniform(places: np.ndarray, which: int) -> np.ndarray:
    """Draws in (0, 1) that depend on the place in the table and ``which`` only."""
    bits = mix64(mix64(places.astype(np.uint64) + np.uint64(1)) ^ mix64(np.uint64([which + 1])))
    return ((bits >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def _draws(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r and log c, both gamma(2, 1) draws, and beta, uniform."""
    u = [_uniform(places, i) for i in range(5)]
    return -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3])), u[4]


def _log_a(r: np.ndarray, log_c: np.ndarray, beta: np.ndarray, step: np.ndarray | float) -> np.ndarray:
    """Log of the value that a term competes with; it depends on the weight through the step only."""
    return (log_c - r * (step - beta + 1)).astype(np.float32)


class WeightedSampler:
    """Consistent weighted samples of term sets; values at weight 1, the usual one, come from a table.

    A sample is the least value and the whole hash of its term, the least hash where
    terms that share draws tie: equal samples mean equal picks of (term, step).
    """

    def __init__(self, samples: int = SAMPLES, term_bits: int = TERM_BITS):
        self.samples, self.term_bits = np.arange(samples), term_bits
        flat = np.empty((1 << term_bits) + samples, np.float32)
        for i in range(0, len(flat), PLACES_AT_ONCE):
            flat[i : i + PLACES_AT_ONCE] = _log_a(*_draws(np.arange(i, min(i + PLACES_AT_ONCE, len(flat)))), 0.0)
        self.at_one = np.lib.stride_tricks.sliding_window_view(flat, samples)

    def fingerprint(self, terms: np.ndarray) -> np.ndarray:
        """A hash of each sample's pick. ``terms`` holds a hash for each occurrence of a term."""
        terms, weights = np.unique(terms, return_counts=True)
        places = (terms >> np.uint64(64 - self.term_bits)).astype(np.int64)
        least, who = np.full(len(self.samples), np.inf, np.float32), np.zeros(len(self.samples), np.int64)
        once, more = np.flatnonzero(weights == 1), np.flatnonzero(weights > 1)
        for i in range(0, len(once), TERMS_AT_ONCE):
            part = once[i : i + TERMS_AT_ONCE]
            _keep_least(self.at_one[places[part]], part, least, who)
        for i in range(0, len(more), TERMS_AT_ONCE):
            part = more[i : i + TERMS_AT_ONCE]
            r, log_c, beta = _draws(places[part, None] + self.samples)
            step = np.floor(np.log(weights[part, None]) / r + beta)
            _keep_least(_log_a(r, log_c, beta, step), part, least, who)
        return mix64(mix64(terms[who]) ^ least.view(np.uint32).astype(np.uint64))


def _keep_least(values: np.ndarray, numbers: np.ndarray, least: np.ndarray, who: np.ndarray) -> None:
    """Put each column's least value and its row's number, the lowest on a tie, in ``least`` and ``who`` if it comes before theirs."""
    low = values.min(axis=0)
    at = np.flatnonzero(low <= least)
    found = numbers[values[:, at].argmin(axis=0)]
    first = (low[at] < least[at]) | (found < who[at])
    least[at[first]], who[at[first]] = low[at[first]], found[first]


def to_text(samples: np.ndarray | None) -> str:
    """Four hex digits a sample; empty for a text without words."""
    return "" if samples is None else (samples >> np.uint64(48)).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal samples of two fingerprints; texts without words are alike only with one another."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(bytes.fromhex(f), ">u2") for f in (a, b))
    return float((x == y).mean())


_SAMPLERS: dict[tuple[int, int], WeightedSampler] = {}


def text_fingerprint(text: str | None, samples: int = SAMPLES, term_bits: int = TERM_BITS) -> str:
    if (samples, term_bits) not in _SAMPLERS:
        _SAMPLERS[samples, term_bits] = WeightedSampler(samples, term_bits)
    terms = shingle_hashes(word_hashes(text))
    return to_text(_SAMPLERS[samples, term_bits].fingerprint(terms) if len(terms) else None)


def fingerprint_texts(df: DataFrame, key: str, text: str, samples: int = SAMPLES) -> DataFrame:
    """(key, fingerprint) of every row's whole text; null counts as empty. No shuffle."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [text_fingerprint(t.as_py(), samples) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], names=[key, "fingerprint"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by the first as many (or all) of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def blocks_with_next(df: DataFrame, key: str, text: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """(k, text, own) dealt to partitions such that each, read in its order, holds the follower of every own row.

    Rows follow one another by rising (key, text), null keys first, the first row after
    the last. A staged range sort of the keys alone gives the blocks' first
    keys, one for every ``rows_per_block`` rows. Then one shuffle deals the texts: each to its
    block, and the first of a block also to the end of the block before, where
    ``own`` is false.
    """
    rows = df.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = rows.count()
    blocks = max(1, -(-n // rows_per_block))
    keys = rows.select("k").repartitionByRange(blocks, "k").withColumn("task", F.spark_partition_id())
    firsts = staged(keys, "fingerprint-keys").groupBy("task").agg(F.min("k").alias("first"), F.count_if(F.col("k").isNull()).alias("nulls"))
    found = firsts.collect()
    bounds = sorted({r["first"] for r in found if r["first"] is not None})
    nulls = any(r["nulls"] for r in found)
    blocks = max(1, len(bounds))
    starts = {b: i for i, b in enumerate(bounds)}

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def block(k: pd.Series) -> pd.Series:
        out = []
        for value in k.tolist():
            missing = value is None or value != value
            own = 0 if missing else max(0, bisect_right(bounds, value) - 1)
            first = missing if nulls and own == 0 else not missing and starts.get(value) == own
            out.append([own, (own - 1) % blocks] if first else [own])
        return pd.Series(out)

    dealt = rows.select("k", "text", F.posexplode(block("k")).alias("copy", "block"))
    dealt = dealt.repartitionById(blocks, F.col("block")).sortWithinPartitions("copy", "k", "text")
    return dealt.select("k", "text", (F.col("copy") == 0).alias("own"))


def fingerprint_edits(df: DataFrame, key: str, text: str, samples: int = SAMPLES) -> DataFrame:
    """Fingerprint every text, its edited text, and compare it with the edit and with the next row's text.

    (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next). Null counts as an empty text; rows that share a key follow one
    another by text; the only row of a table is its own follower; an empty
    table gives an empty result. Keys are integers or strings.
    """
    kind = df.schema[key].dataType.simpleString()
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def row(text: str, own: str, following: str, next_print: str) -> tuple:
        edited = edited_text(text, following)
        edited_print = text_fingerprint(edited, samples) if edited != text else own
        digest = hashlib.sha256(edited.encode()).hexdigest()
        return len(text), digest, own, edited_print, likeness(own, edited_print), likeness(own, next_print)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, whose follower is still to come
        for batch in batches:
            keys, rows = [], []
            for k, value, own in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
                if held and not held[3] and not own:
                    break  # only the first of the next block's rows is needed
                current = (k, value.as_py(), text_fingerprint(value.as_py(), samples), own)
                if held and held[3]:
                    keys.append(held[0].as_py())
                    rows.append(row(*held[1:3], *current[1:3]))
                held = current
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            arrays = [pa.array(keys, batch.schema.field(0).type), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return blocks_with_next(df, key, text).mapInArrow(run, schema)
