"""Sequence batches for models that read the last rows of a series.

Chunks of positions stream through a task in order; a target's window is a view into the rows at hand, so nothing is
copied for each target, no array column is shuffled, and a task holds one Arrow batch and the ``seq_len`` rows before it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SeriesSpec
from . import chunks as ch

#: Windows of a batch, shape (targets, seq_len, columns), read-only -> one array of targets' results for each output.
Scorer = Callable[[np.ndarray], dict[str, np.ndarray]]


def sequence_batches(series: DataFrame, spec: SeriesSpec, seq_len: int, cols: list[str], score: Scorer, outputs: str, keep: list[str] | None = None, size: int | None = None) -> DataFrame:
    """``score`` applied to the previous ``seq_len`` rows of ``cols`` of every target: (entity, ts, *keep, *outputs).

    ``outputs`` is the schema text of what ``score`` returns. Missing numbers are NaN in the windows. Targets with a
    shorter history are left out, as by :func:`features.sliding_windows`; rows with equal times follow one another
    in any order. ``size`` is the positions of a chunk, at least ``seq_len`` (CHUNK_STEPS if not given).
    """
    size = max(size or ch.CHUNK_STEPS, seq_len)
    e, keep = spec.entity, list(keep or [])
    values = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]
    rows = ch.with_halo(ch.placed(series, spec).select(e, spec.ts, *keep, ch.POS, *values), seq_len, size)
    rows = rows.repartition(e, ch.CHUNK).sortWithinPartitions(e, ch.CHUNK, ch.POS)
    wide = len(cols)
    names = [e, spec.ts, *keep]
    made = series.sparkSession.createDataFrame([], outputs).schema
    kinds = ", ".join(f"`{c}` {series.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, tail_at = np.empty((0, wide)), None  # the last rows of the run that the batch before ended in, and who they are
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([batch.column(f"_x{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(wide)])
            own, pos, chunk = (batch.column(c).to_numpy(zero_copy_only=False) for c in (ch.OWN, ch.POS, ch.CHUNK))
            who = batch.column(e).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero((who[1:] != who[:-1]) | (chunk[1:] != chunk[:-1])) + 1
            edges = [0, *starts.tolist(), batch.num_rows]
            found, results = [], []
            for lo, hi in zip(edges[:-1], edges[1:]):
                at = (batch.column(e)[lo].as_py(), int(chunk[lo]))
                before = tail if lo == 0 and at == tail_at else tail[:0]
                run_x = np.concatenate([before, x[lo:hi]]) if len(before) else x[lo:hi]
                first = max(seq_len - len(before), 0)  # of the rows of this batch, the first with a whole window
                if hi - lo > first:
                    begin = len(before) + first - seq_len
                    windows = sliding_window_view(run_x[begin:-1], seq_len, axis=0).transpose(0, 2, 1)
                    mine = own[lo + first : hi]
                    # a halo's rows come first, so the targets are one stretch
                    skip = int(len(mine) - mine.sum())
                    if skip < len(mine):
                        found.append(np.arange(lo + first + skip, hi))
                        results.append(score(windows[skip:]))
                tail, tail_at = run_x[-seq_len:].copy(), at
            if found:
                taken = batch.select(names).take(pa.array(np.concatenate(found)))
                arrays = [pa.array(np.concatenate([np.asarray(r[f.name]) for r in results]), from_pandas=True) for f in made.fields]
                yield pa.RecordBatch.from_arrays([*taken.columns, *arrays], names=[*names, *[f.name for f in made.fields]])

    return rows.mapInArrow(run, f"{kinds}, {outputs}")
