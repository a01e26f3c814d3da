"""N-gram Jaccard self-join by MinHash banding, every link verified on full n-gram sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.llm.common import SHINGLE_WORDS, block_links, connected_components, core_links, give_back, in_blocks, links_to_rows, mix64, shingle_hashes, staged, word_hashes

THRESHOLD = 0.8
TARGET_RECALL = 0.995
MAX_HASHES = 128
BLOCK_ROWS = 512
COLUMNS_AT_ONCE = 4096
#: A large family's centre is what most of about this many of its members hold.
CENTRE_SAMPLE = 64


def choose_bands(threshold: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows per band): the most selective rows whose bands find a pair at the threshold with the target recall."""
    best = None
    for rows in range(1, max_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows > max_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("no bands reach the recall with so few hashes")
    return best


def shingle_set(text: str | None, k: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(text), k))


def band_hashes(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit hash of the MinHash values of each band."""
    least = np.empty(bands * rows, np.uint64)
    for i in range(len(least)):  # a multiply and an add permute 64-bit hashes; the high bits rank them
        a, b = _COEFFICIENTS[i]
        least[i] = (shingles * a + b).min()
    out = np.zeros(bands, np.uint64)
    for column in least.reshape(bands, rows).T:
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out.view(np.int64)


_seeds = mix64(np.arange(1, 2 * 1024 + 1, dtype=np.uint64))
_COEFFICIENTS = np.stack([_seeds[::2] | np.uint64(1), _seeds[1::2]], axis=1)


def set_class(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def similar(sets: list[np.ndarray], left: np.ndarray, threshold: float) -> np.ndarray:
    """Symmetric matrix of the pairs with Jaccard >= threshold.

    Where ``left`` holds True and False, only pairs across the two are compared.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.float64)
    a = np.flatnonzero(left) if left.any() and not left.all() else np.arange(n)
    b = np.flatnonzero(~left) if left.any() and not left.all() else np.arange(n)
    shared = np.zeros((len(a), len(b)), np.float32)
    owner = np.repeat(np.arange(n), sizes.astype(np.int64))
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    keep = times[column] > 1  # an n-gram of one set is in no intersection
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = int((times > 1).sum())
    for start in range(0, total, COLUMNS_AT_ONCE):
        i, j = np.searchsorted(column, [start, start + COLUMNS_AT_ONCE])
        has = np.zeros((n, min(COLUMNS_AT_ONCE, total - start)), np.float32)
        has[owner[i:j], column[i:j] - start] = 1
        shared += has[a] @ has[b].T
    linked = np.zeros((n, n), bool)
    linked[np.ix_(a, b)] = shared / (sizes[a][:, None] + sizes[b][None, :] - shared) >= threshold
    linked |= linked.T
    np.fill_diagonal(linked, False)
    return linked


def _verify(k: int, threshold: float):
    """Links within each block of rows (group, block_i, block_j, chunk, node, class, copies, text), sorted by block."""

    def links(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held: dict[int, tuple] = {}
        for _, _, _, chunk, node, class_, copies, text in rows:
            if node not in held:
                shingles = shingle_set(text, k)
                if set_class(shingles) == class_:  # else another text under a repeated key
                    held[node] = (chunk, copies, shingles)
        nodes = np.array(sorted(held), np.int64)
        chunks = np.array([held[v][0] for v in nodes.tolist()])
        weights = np.array([held[v][1] for v in nodes.tolist()], np.int64)
        if len(nodes) < 2:
            return nodes[:0], weights[:0], nodes[:0]
        return block_links(similar([held[v][2] for v in nodes.tolist()], chunks == rows[0][1], threshold), nodes, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = None, []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in links(rows)], names=["node", "linked", "low"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != block:
                    if len(rows) > 1:
                        yield done()
                    block, rows = row[:3], []
                rows.append(row)
        if len(rows) > 1:
            yield done()

    return run


def _centres(k: int):
    """(group, centre) from rows (group, text) sorted by group: the n-grams that more than half of the group's texts hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sets = None, []

        def done() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(sets), return_counts=True)
            centre = values[2 * times > len(sets)].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array([group]), pa.array([centre], pa.list_(pa.int64()))], names=["component", "centre"])

        for batch in batches:
            for now, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if now != group and sets:
                    yield done()
                    sets = []
                group = now
                sets.append(shingle_set(text.as_py(), k))
        if sets:
            yield done()

    return run


def _near_centre(k: int, likeness: float):
    """(node, core) from rows (node, class, text, centre): Jaccard with the centre of at least ``likeness``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, core = [], []
            for node, class_, text, centre in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                shingles = shingle_set(text.as_py(), k)
                if set_class(shingles) != class_:
                    continue
                middle = centre.values.to_numpy(zero_copy_only=False).view(np.uint64)
                shared = len(np.intersect1d(shingles, middle, assume_unique=True))
                nodes.append(node)
                core.append(shared / (len(shingles) + len(middle) - shared) >= likeness)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(core, pa.bool_())], names=["node", "core"])

    return run


def _core_members(members: DataFrame, texts: DataFrame, threshold: float, k: int) -> DataFrame:
    """``members`` with ``core``: rows of a family larger than a block that are so near to one centre that all of them are linked.

    1 - Jaccard is a metric on sets. So two texts at no more than half the
    allowed distance from any third set are within the allowed distance of one another, whatever
    that set is: a centre that fits badly makes fewer rows core, never a wrong link.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK_ROWS)
    large = texts.join(sizes, "component")
    drawn = F.pmod(F.xxhash64(F.lit("centre"), "node"), F.lit(1 << 30)) < (F.lit(CENTRE_SAMPLE) / F.col("n") * (1 << 30)).cast("long")
    sample = large.where(drawn).select("component", "text").repartition("component").sortWithinPartitions("component")
    centres = staged(sample.mapInArrow(_centres(k), "component long, centre array<bigint>"), "ngram-centres")
    near = large.join(centres, "component").select("node", "class", "text", "centre")
    core = near.mapInArrow(_near_centre(k, 1 - (1 - threshold) / 2), "node long, core boolean")
    core = staged(core.where("core").distinct(), "ngram-core")
    return members.join(core, "node", "left").withColumn("core", F.coalesce("core", F.lit(False)))


def ngram_links(
    df: DataFrame, key: str, text: str, threshold: float = THRESHOLD, k: int = SHINGLE_WORDS, recall: float = TARGET_RECALL, max_hashes: int = MAX_HASHES
) -> DataFrame:
    """(key, n_links, component_id, kept): each row's links by Jaccard >= threshold of its sets of k-word n-grams.

    Words are lower-cased runs of letters, digits and underscores; a text of
    fewer than k words is one n-gram, one without words (or null) has no set and
    links with nothing. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest key reachable by links, ``kept`` marks its row.
    Rows with a null key link with nothing and are kept. Other columns are not read.

    Equal sets are one class from the start (partial counts, so a hot copy costs
    a count). Classes that share a band hash form families (components of star
    edges, not pairs). In a family larger than a block, the texts near its centre are
    linked by the triangle inequality, in time linear in their number; the pairs left, and all
    pairs of small families, are compared on full sets inside the tasks,
    which return counts and one edge a row: no pair is ever a row.
    """
    bands, rows = choose_bands(threshold, recall, max_hashes)
    kind = df.schema[key].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, signed = [], []
            for id_, value in zip(batch.column(0), batch.column(1), strict=True):
                shingles = shingle_set(value.as_py(), k) if id_.is_valid else ()
                classes.append(set_class(shingles) if len(shingles) else None)
                signed.append(band_hashes(shingles, bands, rows) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(classes, pa.binary()), pa.array(signed, pa.list_(pa.int64()))], names=["key", "class", "bands"])
            del batch, classes, signed
            give_back()

    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    signed = staged(docs.mapInArrow(sign, f"key {kind}, class binary, bands array<bigint>"), "ngram-signatures")
    classes = signed.where("class IS NOT NULL").groupBy("class").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "ngram-classes")

    buckets = classes.select("node", F.posexplode("bands").alias("band", "hash"))
    shared = buckets.groupBy("band", "hash").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = buckets.join(shared, ["band", "hash"]).select(F.col("node").alias("src"), F.col("low").alias("dst"))
    families = connected_components(stars, "ngram-families")

    members = staged(families.join(classes.drop("bands"), "node"), "ngram-members")
    # the families are a share of the documents, so both sides are dealt by key at every size
    texts = members.hint("merge").join(docs, members["rep"] == docs["key"]).select("component", "node", "class", "text")
    texts = staged(texts, "ngram-texts")
    members = staged(_core_members(members, texts, threshold, k), "ngram-core-members")
    block = ["component", "block_i", "block_j"]
    blocks = in_blocks(members.select("component", "node", "copies", "core"), "component", "node", BLOCK_ROWS)
    rows_in = blocks.hint("merge").join(texts.select("node", "class", "text"), "node")
    rows_in = rows_in.select(*block, "chunk", "node", "class", "copies", "text").repartition(*block).sortWithinPartitions(*block, "node")
    links = rows_in.mapInArrow(_verify(k, threshold), "node long, linked long, low long")
    links = staged(links.union(core_links(members, "component")), "ngram-links")
    return links_to_rows(signed.select("key", "class"), classes.drop("bands"), links, key, "ngram-components")
