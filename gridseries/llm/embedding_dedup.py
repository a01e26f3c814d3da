"""Embedding near-duplicates by a pivot-permutation index.

A vector is described by its nearest reference points, in order. Inverted lists
hold, for each pivot, the vectors that name it; vectors that share enough pivots
are candidates, and candidates are verified by their cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.llm.common import block_links, core_links, in_blocks, links_to_rows, staged

THRESHOLD = 0.95
#: Depths of a vector's prefix, in nearest pivots, of which the first that finds TARGET_RECALL of calibration pairs is taken.
PREFIXES = (4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128)
TARGET_RECALL = 0.99
CALIBRATION_PAIRS = 2048
#: Vectors of a length that no more than this many have are all compared with one another.
FEW = 2048
LEAST_PIVOTS, MOST_PIVOTS = 64, 16_384
#: Pivots are picked from this many sampled vectors for each of them.
SAMPLE_PER_PIVOT = 4
BLOCK_ROWS = 512
#: Dense places are looked for in at most this many sampled vectors; one needs so many of them within half the allowed angle.
PLACE_SAMPLE = 4096
DENSE = 8


def n_pivots(n: int) -> int:
    """A power of two near twice the square root, so that lists grow as slowly as the pivots do."""
    return min(MOST_PIVOTS, max(LEAST_PIVOTS, 1 << math.ceil(math.log2(max(1.0, 2 * math.sqrt(n))))))


def unit(vector: np.ndarray) -> np.ndarray | None:
    """The vector at length 1 in double precision; None if it is empty, zero or not finite."""
    x = np.asarray(vector, np.float64)
    if not x.size or not np.isfinite(x).all():
        return None
    top = np.abs(x).max()
    if top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each pivot is the sampled vector least like those before it, so a dense group gets few."""
    picked = [0]
    nearest = sample @ sample[0]
    while len(picked) < min(n, len(sample)):
        at = int(nearest.argmin())
        if nearest[at] > 1 - 1e-9:
            break
        picked.append(at)
        nearest = np.maximum(nearest, sample @ sample[at])
    return sample[picked]


def dense_centres(sample: np.ndarray, threshold: float) -> np.ndarray:
    """Mean directions of the dense places of the sample, the densest first; vectors near one are linked with one another."""
    angle = np.arccos(threshold)
    sample = sample[:PLACE_SAMPLE]
    near = np.concatenate([sample[i : i + 256] @ sample.T >= np.cos(angle) for i in range(0, len(sample), 256)]) if len(sample) else np.zeros((0, 0), bool)
    free, centres = np.ones(len(sample), bool), []
    while len(sample):
        degree = (near & free[None, :]).sum(axis=1) * free
        at = int(degree.argmax())
        if degree[at] < DENSE:
            break
        mean = sample[near[at] & free].sum(axis=0)
        covered = free & (sample @ (mean / np.linalg.norm(mean)) >= np.cos(angle / 2))
        if covered.sum() >= DENSE:
            centres.append(mean / np.linalg.norm(mean))
        free &= ~covered
        free[at] = False
    return np.array(centres).reshape(len(centres), sample.shape[1])


def centred(vectors: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Directions from the mean: a direction that all vectors share says nothing about which are near."""
    away = vectors - mean
    return away / np.maximum(np.sqrt((away * away).sum(axis=1, keepdims=True)), 1e-12)


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, depth: int) -> np.ndarray:
    """The ``depth`` most alike pivots of each vector, in order."""
    likeness = vectors @ pivots.T
    top = np.argpartition(-likeness, depth - 1, axis=1)[:, :depth]
    order = np.argsort(-np.take_along_axis(likeness, top, axis=1), axis=1, kind="stable")
    return np.take_along_axis(top, order, axis=1)


def calibrate(sample: np.ndarray, pivots: np.ndarray, mean: np.ndarray, threshold: float) -> tuple[int, int]:
    """(depth, shared): the shortest prefix, and of one or two shared pivots the most, that find TARGET_RECALL of pairs at the threshold.

    The pairs are made from the sample itself: each vector is turned towards another one until their
    cosine is the threshold, so they lie as far apart as links may, in directions that the data have.
    """
    rng = np.random.default_rng(3)
    left = sample[rng.permutation(len(sample))[:CALIBRATION_PAIRS]]
    right = sample[rng.integers(0, len(sample), len(left))]
    cosine = (left * right).sum(axis=1, keepdims=True)
    aside = right - cosine * left
    size = np.sqrt((aside * aside).sum(axis=1, keepdims=True))
    keep = (size > 1e-6)[:, 0]
    if not keep.any():
        return min(PREFIXES[0], len(pivots)), 1
    turned = threshold * left[keep] + math.sqrt(1 - threshold**2) * aside[keep] / size[keep]
    most = min(PREFIXES[-1], len(pivots))
    a, b = (nearest_pivots(centred(v, mean), pivots, most) for v in (left[keep], turned))
    depths = sorted({min(d, most) for d in PREFIXES})
    shared = np.zeros((len(a), len(depths)), np.int32)
    for i in range(0, len(a), 256):
        same = a[i : i + 256, :, None] == b[i : i + 256, None, :]
        shared[i : i + 256] = np.stack([same[:, :d, :d].sum(axis=(1, 2)) for d in depths], axis=1)
    one = next((i for i in range(len(depths)) if (shared[:, i] >= 1).mean() >= TARGET_RECALL), len(depths) - 1)
    two = next((i for i in range(len(depths)) if (shared[:, i] >= 2).mean() >= TARGET_RECALL), None)
    # a second shared pivot spares work only if it takes little more depth
    return (depths[two], 2) if two is not None and two <= one + 1 else (depths[one], 1)


def shared_pivots(prefixes: np.ndarray, pivot: int) -> tuple[np.ndarray, np.ndarray]:
    """Within one pivot's list: how many pivots each two vectors share, and whether a lower one is among them."""
    n = len(prefixes)
    count, lower = np.ones((n, n), np.int16), np.zeros((n, n), bool)
    flat, owner = prefixes.ravel(), np.repeat(np.arange(n), prefixes.shape[1])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    edges = np.flatnonzero(np.diff(flat, prepend=-1, append=-1))
    for i, j in zip(edges, edges[1:], strict=False):
        if flat[i] != pivot and j - i > 1:
            at = np.ix_(owner[i:j], owner[i:j])
            count[at] += 1
            if flat[i] < pivot:
                lower[at] = True
    return count, lower


def _verify(threshold: float, shared: int, n_places: int):
    """Links within each block of rows (list, block_i, block_j, chunk, core, node, copies, vector, prefix), sorted by block."""

    def links(number: int, block_i: int, parts: list[list]) -> list[np.ndarray]:
        chunk, core, nodes, copies = (np.concatenate(p) for p in parts[:4])
        vectors, prefixes = np.concatenate(parts[4]), np.concatenate(parts[5])
        if number < n_places:  # a dense place: its own vectors against those on its border
            candidates = core[:, None] != core[None, :]
        else:
            count, lower = shared_pivots(prefixes, number - n_places)
            candidates = (count >= shared) & ~lower  # each pair is looked at in the list of its lowest shared pivot
        left = chunk == block_i
        if not left.all():
            candidates &= left[:, None] != left[None, :]
        np.fill_diagonal(candidates, False)
        candidates &= vectors @ vectors.T >= threshold
        return list(block_links(candidates, nodes, copies))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = None, []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in links(block[0], block[1], parts)], names=["node", "linked", "low"])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            heads = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5, 6)]
            edges = [0, *(np.flatnonzero((heads[1:] != heads[:-1]).any(axis=1)) + 1).tolist(), n]
            for i, j in zip(edges, edges[1:], strict=False):
                now = tuple(heads[i].tolist())
                if now != block:
                    if block:
                        yield done()
                    block, parts = now, [[] for _ in range(6)]
                # blocks differ in the length of their vectors
                flat = [batch.column(c).slice(i, j - i).flatten().to_numpy().reshape(j - i, -1) for c in (7, 8)]
                for part, column in zip(parts, [*(c[i:j] for c in columns), *flat], strict=True):
                    part.append(column)
        if block:
            yield done()

    return run


def embedding_links(df: DataFrame, key: str, vector: str, threshold: float = THRESHOLD) -> DataFrame:
    """(key, n_links, component_id, kept): each vector's links by cosine >= threshold in double precision.

    Vectors that are null, empty or zero or that hold null or non-finite components
    link with nothing, as do rows with a null key; vectors of different lengths do not link. An empty table gives an empty result.
    ``n_links`` counts the other vectors linked directly, ``component_id`` is the
    smallest key reachable by links, ``kept`` marks its row. Other columns are not read.

    Equal vectors are one class from the start; each length has an index of its own. Pivots, about 2 sqrt(n), come from a
    sample of 4 for each; the index holds every vector, described by its direction from the sample's mean. Two
    vectors are candidates if their prefixes, the nearest pivots in order, share enough of them; how long a prefix and how many are
    enough is measured on the sample (:func:`calibrate`), so recall holds for data of any spread and any number of pivots. Each
    pair is looked at once, in the list of its lowest shared pivot. Vectors within half
    the allowed angle of a dense place of the sample are linked by the triangle inequality, in time
    linear in their number, and only vectors on the place's border are compared with them, so a group of near
    copies fills no list. Long lists are dealt in blocks, and tasks return counts and
    one edge a vector, never pairs.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = []
            for id_, v in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                units.append(unit(v) if id_.is_valid and v is not None and None not in v else None)
            classes = [None if u is None else xxhash.xxh3_128_digest(u.tobytes()) for u in units]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(classes, pa.binary()), pa.array(units, pa.list_(pa.float64()))], names=["key", "class", "vector"])

    rows = staged(df.select(F.col(key).alias("key"), F.col(vector).alias("vector")).mapInArrow(normalise, f"key {kind}, class binary, vector array<double>"), "vectors")
    classes = rows.where("class IS NOT NULL").groupBy("class").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("length", F.size("vector")), "vector-classes")
    # a row for each length of a vector
    counts = {r["length"]: r["n"] for r in classes.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    many = sorted(length for length, n in counts.items() if n > FEW)
    rare = classes.where(~F.col("length").isin(many)) if many else classes
    links = _few_links(rare, threshold)
    for length in many:
        links = links.unionByName(_index_links(classes.where(F.col("length") == length), counts[length], threshold))
    return links_to_rows(rows.select("key", "class"), classes.drop("vector", "length"), links, key, "vector-components")


def _few_links(classes: DataFrame, threshold: float) -> DataFrame:
    """(node, linked, low) of vectors of rare lengths: each length is one list, of bounded size."""
    listed = classes.select(F.col("length").alias("list"), "node", "copies", F.lit(False).alias("core"))
    return _verified(listed, classes.select("node", "vector", F.array("length").alias("prefix")), threshold, 1, 0)


def _verified(listed: DataFrame, index: DataFrame, threshold: float, shared: int, n_places: int) -> DataFrame:
    """Links between the rows that meet in a list, block by block."""
    block = ["list", "block_i", "block_j"]
    blocks = in_blocks(listed, "list", "node", BLOCK_ROWS).join(index.select("node", "vector", "prefix"), "node")
    columns = ["list", "block_i", "block_j", "chunk", "core", "node", "copies", "vector", "prefix"]
    sorted_blocks = blocks.select(*columns).repartition(*block).sortWithinPartitions(*block)
    return sorted_blocks.mapInArrow(_verify(threshold, shared, n_places), "node long, linked long, low long")


def _index_links(classes: DataFrame, n: int, threshold: float) -> DataFrame:
    """(node, linked, low) of ``n`` vectors of one length, by their pivot index."""
    spark = classes.sparkSession
    wanted = n_pivots(n) * SAMPLE_PER_PIVOT
    drawn = classes.where(F.pmod(F.xxhash64(F.lit("pivot"), "class"), F.lit(1 << 30)) < int(min(1.0, wanted / n) * (1 << 30)))
    sample = np.stack(drawn.select("vector").toPandas()["vector"].to_list())
    mean = sample.mean(axis=0)
    pivots = choose_pivots(centred(sample, mean), n_pivots(n))
    depth, least_shared = calibrate(sample, pivots, mean, threshold)
    centres = dense_centres(sample, threshold)
    held = spark.sparkContext.broadcast((pivots, centres, mean))
    half, reach = np.cos(np.arccos(threshold) / 2) + 1e-9, np.cos(np.arccos(threshold) * 1.5) - 1e-9

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reference, dense, middle = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            near, places, borders = np.empty((len(vectors), depth), np.int32), [], []
            for i in range(0, len(vectors), 1024):
                part = vectors[i : i + 1024]
                near[i : i + 1024] = nearest_pivots(centred(part, middle), reference, depth)
                if len(dense):
                    to_dense = part @ dense.T
                    own = to_dense.argmax(axis=1)
                    own[to_dense[np.arange(len(part)), own] < half] = -1
                    # of two dense places the lower one looks at the pairs between them
                    border = (to_dense >= reach) & ((own[:, None] < 0) | (np.arange(len(dense))[None, :] < own[:, None]))
                    places += [int(o) if o >= 0 else None for o in own]
                    borders += [np.flatnonzero(b) for b in border]
                else:
                    places += [None] * len(part)
                    borders += [()] * len(part)
            prefixes = pa.ListArray.from_arrays(pa.array(np.arange(0, near.size + 1, depth), pa.int32()), pa.array(near.ravel()))
            arrays = [*batch.columns, prefixes, pa.array(places, pa.int32()), pa.array(borders, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "copies", "vector", "prefix", "place", "borders"])

    schema = "node long, copies long, vector array<double>, prefix array<int>, place int, borders array<int>"
    index = staged(classes.select("node", "copies", "vector").mapInArrow(describe, schema), "pivot-index")

    # vectors at a dense place are linked with one another; what borders the place is compared with it
    inside = index.where("place IS NOT NULL").select(F.col("place").alias("list"), "node", "copies", F.lit(True).alias("core"))
    links = core_links(inside, "list")
    border = index.select(F.explode("borders").alias("list"), "node", "copies", F.lit(False).alias("core"))
    # all others, and what they are near to, meet in the lists of their pivots, numbered after the places
    listed = index.where("place IS NULL").select(F.explode(F.transform("prefix", lambda p: p + len(centres))).alias("list"), "node", "copies", F.lit(False).alias("core"))
    found = _verified(inside.union(border).union(listed), index, threshold, least_shared, len(centres))
    return staged(found.union(links), "vector-links")
