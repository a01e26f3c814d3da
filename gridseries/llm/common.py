"""Helpers shared by the corpus operators: staged tables, memory of Python workers, word hashes, components."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.session import ensure_checkpoint_dir

#: Unicode White_Space, which tokenizer patterns call ``\s``; Python's own ``\s`` holds four more.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_WORD, _MARK = "A-Za-z0-9À-ÖØ-öø-ɏ", r"!-/:-@\[-`{-~"
#: Cuts text where the byte-level token pattern never matches across: a plain word before a mark or white space,
#: marks before white space, other runs, white space.
CHUNKS = re.compile(
    rf" ?[{_WORD}]+(?=[{_MARK}{WHITE_SPACE}]|\Z)| ?[{_MARK}]+(?=[{WHITE_SPACE}]|\Z)| ?[^{WHITE_SPACE}]+"
    rf"|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
)
WORDS = re.compile(r"\w+")
SHINGLE_WORDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-scratch/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a narrow intermediate table to the shared folder and read it again.

    The lineage ends there: a lost executor costs a re-read, not a recomputation,
    and values that depend on the task (ids, offsets) are fixed once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_KEPT: dict[str, Any] = {}
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def worker_state(operator: str, build: Callable[[], Any]) -> Any:
    """What this Python worker keeps from one task of an operator to the next, built on first use.

    A worker outlives the operator's stages, so it keeps one operator's state at a time: the next one's tasks replace it.
    """
    if operator not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[operator] = build()
    return _KEPT[operator]


def give_back() -> None:
    """Return memory that is free to the system, which Arrow and the allocator keep after a batch of whole texts."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


class HashCache(dict):
    """word -> 64-bit hash, emptied when it holds ``limit`` words."""

    limit = 200_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply) on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    words = WORDS.findall(text.lower()) if text else []
    return np.fromiter(map(worker_state("word_hashes", HashCache).__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """A 64-bit hash of every run of ``k`` words, in order; a shorter text is one run, a text without words none."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, k)
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out = mix64(out * _STEP + words[i : n - width + 1 + i])
    return out


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of an undirected graph given as (src, dst); component is the smallest node reached.

    Alternating large-star and small-star rounds over joins and minimum
    aggregates: no neighbour list is ever gathered, so a hub is only a skewed
    join key, which adaptive execution splits. Each round is staged in the shared
    folder. Nodes without an edge do not occur in the result.
    """

    def sides(e: DataFrame) -> DataFrame:
        return e.select("src", "dst").union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    edges = staged(
        edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(),
        name,
    )
    before = state(edges)
    while before[0]:
        both = sides(edges)
        # the minima are staged first: a join of two plain tables is one whose hub keys adaptive execution can split
        large = both.join(staged(least(both), name), "src").where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        large = staged(large.where("src <> dst").distinct(), name)
        # every edge now points from a node to a smaller one
        low = staged(large.groupBy("src").agg(F.min("dst").alias("low")), name)
        small = large.join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).where("src <> dst")
        small = small.union(low.select("src", F.col("low").alias("dst"))).distinct()
        edges = staged(small, name)
        after = state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return nodes.union(edges.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())


def in_blocks(members: DataFrame, group: str, node: str, size: int) -> DataFrame:
    """Deal each group's rows to blocks that together hold every pair that is still open.

    ``members`` has a column ``core``: two core rows of a group are known to be
    linked, every other pair is open. The n rows that are not core are cut into
    ceil(n / size) chunks by a hash of the node, and the core rows likewise;
    block (i, j) with i <= j holds chunks i and j, so a task sees at most about twice
    ``size`` rows however large the group. Core chunks meet the others only, so a
    group that is all core makes no block. Adds (block_i, block_j, chunk).
    """
    open_ = (~F.col("core")).cast("long")
    counts = members.groupBy(group).agg(F.sum(open_).alias("n_open"), F.count(F.lit(1)).alias("n_all")).where("n_all > 1 AND n_open > 0")
    rows = members.join(counts, group)
    p, q = F.ceil(F.col("n_open") / size).cast("int"), F.ceil((F.col("n_all") - F.col("n_open")) / size).cast("int")
    spread = F.xxhash64(F.lit("chunk"), node)
    rows = rows.withColumn("p", p).withColumn("q", q)
    rows = rows.withColumn("chunk", F.when(F.col("core"), F.col("p") + F.pmod(spread, F.greatest("q", F.lit(1)))).otherwise(F.pmod(spread, F.col("p"))).cast("int"))
    others = F.when(F.col("core"), F.col("p")).otherwise(F.col("p") + F.col("q"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), others.cast("int") - 1)))
    rows = rows.withColumn("block_i", F.least("chunk", "other")).withColumn("block_j", F.greatest("chunk", "other"))
    return rows.drop("n_open", "n_all", "p", "q", "other")


def core_links(members: DataFrame, group: str) -> DataFrame:
    """(node, linked, low) of the core rows (group, node, copies, core): each is linked with all others of its group.

    Two partial sums and one join, however large the group.
    """
    core = members.where("core").select(group, "node", "copies")
    total = core.groupBy(group).agg(F.sum("copies").alias("total"), F.min("node").alias("low"))
    return core.join(total, group).select("node", (F.col("total") - F.col("copies")).alias("linked"), "low")


def block_links(linked: np.ndarray, nodes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From a symmetric link matrix: (node, total weight of its links, least node that it reaches in the block) of linked nodes."""
    at = np.flatnonzero(linked.any(axis=1))
    if not len(at):
        return nodes[:0], weights[:0], nodes[:0]
    linked = linked[np.ix_(at, at)]
    total, low = linked @ weights[at], nodes[at].copy()
    # one sweep marks whole neighbourhoods: as many steps as the longest chain
    while True:
        reach = np.where(linked, low[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(low, reach)
        if (new == low).all():
            return nodes[at], total, low
        low = new


def links_to_rows(rows: DataFrame, classes: DataFrame, links: DataFrame, key: str, name: str) -> DataFrame:
    """One row per input row: (key, n_links, component_id, kept).

    ``rows`` (key, class), ``classes`` (node, class, rep, copies) of different
    values, ``links`` (node, linked, low) from the blocks. Copies of one value link with one another.
    A null class links with nothing.
    """
    counted = links.groupBy("node").agg(F.sum("linked").alias("linked"))
    component = connected_components(links.select(F.col("node").alias("src"), F.col("low").alias("dst")), name)
    table = classes.join(counted, "node", "left").join(component, "node", "left")
    table = table.withColumn("component", F.coalesce("component", "node"))
    table = staged(table.select("class", "rep", "component", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), f"{name}-classes")
    first = table.groupBy("component").agg(F.min("rep").alias("component_id"))
    table = table.join(first, "component").select("class", "n_links", "component_id")
    out = rows.join(table, "class", "left")
    own = F.coalesce(F.col("component_id"), F.col("key"))
    return out.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("key") == own, F.lit(True)).alias("kept"),
    )
