"""Language-model scores of a hashed maximum-entropy model.

The next token's distribution is a product of two softmaxes: its class among 32, then its leaf
among the 32 of that class. A leaf is one frequent word, or the rarer words whose last two letters hash
alike; within a leaf, words have their share of the leaf's counts, which does not depend on the context. Both softmaxes sum
the weights of hashed features: the previous word (bigram), the two previous words (trigram), and the words
two and three places back (skips). Weights start from one iterative-scaling step on the counts of all training texts and are
then moved by gradient updates that between them go through all training texts once; Spark gathers their sums over tasks.

With all weights zero the model is the unigram model. One event stands for all tokens that training never met;
it gets the mass that absolute discounting takes from the words that it met.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.blocks import by_block, code_blocks, one_list, packed, raw_binary, record, reunite, slices, unpacked
from gridseries.llm.common import staged

DIGITS = 32
LEAVES = DIGITS * DIGITS
#: Leaf 0 is the end of a text, the next ones are the most frequent words, the others hold words by their ending.
FREQUENT = 512
ENDINGS = LEAVES - FREQUENT
START = LEAVES
#: A token is 16 bits: its leaf, whether training never met it, and five bits of the word's hash, which tell words of one leaf apart as contexts.
UNKNOWN, HASH_BITS = 1024, 11
DISCOUNT = 0.5

FEATURES = 4
CLASS_ROWS = 4096
LEAF_ROWS = 384
ROWS = FEATURES * CLASS_ROWS + DIGITS * FEATURES * LEAF_ROWS
_MIX_CLASS = np.array([2654435761, 2246822519, 3266489917, 668265263], np.uint32)
_MIX_LEAF = np.array([374761393, 2654435789, 2246822507, 3266489909], np.uint32)

#: So few that a run's softmaxes stay in the processor's cache.
TOKENS_AT_ONCE = 4096
#: So many that adding up the weights' rows costs less than the tokens.
SPREADS_AT_ONCE = 32_768
DOCS_AT_ONCE_TOKENS = 1_000_000
PRIOR_COUNT = 4.0
#: Each task of a gradient update hands in a table of fixed size, so it reads several files.
FILES_A_TASK = 4
#: Entries of the blocks' dictionaries whose counts are added up together.
BUCKET_ENTRIES = 500_000
RATES = (0.5, 0.35, 0.25)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts, A-Z lowered, parted by space and the controls 9 to 13, and how many each text has."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, parent = words.flatten(), pc.list_parent_indices(words).to_numpy()
    there = pc.not_equal(flat, "")
    return flat.filter(there), np.bincount(parent[there.to_numpy(zero_copy_only=False)], minlength=len(texts))


def word_facts(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the number of its ending."""
    known = words.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known)).view(np.int64)
    endings = np.fromiter((xxhash.xxh32_intdigest(w[-2:]) for w in known), np.uint32, len(known)) % ENDINGS
    return hashes, endings.astype(np.int16)


@dataclass
class Vocabulary:
    """Totals of the training tokens, and what the leaves hold: bounded by their number, whatever the corpus."""

    docs: int
    words: int
    tokens: int
    frequent: np.ndarray
    leaf_mass: np.ndarray = field(repr=False)

    @property
    def distinct(self) -> int:
        return self.words + (self.docs > 0)

    @property
    def unknown(self) -> float:
        """The probability of a token that training never met."""
        return DISCOUNT * self.distinct / self.tokens if self.tokens else 1.0

    def leaves(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        """The leaf of each word."""
        order = np.argsort(self.frequent)
        at = np.searchsorted(self.frequent, hashes, sorter=order)
        at = order[np.minimum(at, len(order) - 1)] if len(order) else np.zeros(len(hashes), np.int64)
        hit = self.frequent[at] == hashes if len(order) else np.zeros(len(hashes), bool)
        return np.where(hit, 1 + at, FREQUENT + endings).astype(np.int16)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the add-one unigram estimate."""
        return np.log10((counts + 1) / (self.tokens + self.distinct + 1))

    def inner(self, counts: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """log10 of what the context does not change: known or not, and the word's share of its leaf."""
        known = counts > 0
        share = np.where(known, counts - DISCOUNT, 1) / np.where(known, self.leaf_mass[leaves], 1)
        return np.where(known, np.log10(max(1 - self.unknown, 1e-300)) + np.log10(share), np.log10(self.unknown) if self.unknown else 0.0)


def _vocabulary(counted: DataFrame, n_docs: int) -> Vocabulary:
    """From the buckets' sums and most frequent words: a row for each leaf reaches the driver."""
    rows = counted.where("block IS NULL")
    groups = rows.select(F.posexplode(F.arrays_zip("n", "words")).alias("ending", "g")).groupBy("ending").agg(F.sum("g.n").alias("n"), F.sum("g.words").alias("words")).where("words > 0").collect()
    top = rows.select(F.explode(F.arrays_zip("top", "top_ending", "top_n")).alias("t")).select("t.*").orderBy(F.desc("top_n"), "top").limit(FREQUENT - 1).collect()
    mass = np.zeros(LEAVES)
    mass[0] = max(0.0, n_docs - DISCOUNT)
    for g in groups:
        mass[FREQUENT + g["ending"]] = g["n"] - DISCOUNT * g["words"]
    for i, w in enumerate(top):
        mass[1 + i] = w["top_n"] - DISCOUNT
        mass[FREQUENT + w["top_ending"]] -= w["top_n"] - DISCOUNT
    # what is left of an ending whose words are all frequent is a rounding residue
    mass[mass < DISCOUNT / 2] = 0
    frequent = np.array([w["top"] for w in top], np.int64)
    return Vocabulary(n_docs, sum(g["words"] for g in groups), n_docs + sum(g["n"] for g in groups), frequent, mass)


class Maxent:
    """Weights of the hashed features and the unigram mass of classes and leaves."""

    def __init__(self, leaf_mass: np.ndarray, weights: np.ndarray):
        mass = leaf_mass.reshape(DIGITS, DIGITS)
        by_class = mass.sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.class_prior = np.nan_to_num(by_class / by_class.sum()).astype(np.float32)
            self.leaf_prior = np.nan_to_num(mass / by_class[:, None]).astype(np.float32)
            self.log_class, self.log_leaf = np.log(self.class_prior), np.log(self.leaf_prior)
        self.weights = weights

    def row_priors(self) -> np.ndarray:
        """The unigram distribution that each row of weights bends."""
        leaf = np.tile(np.repeat(self.leaf_prior, LEAF_ROWS, axis=0), (FEATURES, 1))
        return np.concatenate([np.repeat(self.class_prior[None], FEATURES * CLASS_ROWS, axis=0), leaf])

    def log_probability(self, class_rows: list[np.ndarray], leaf_rows: list[np.ndarray], target: np.ndarray, spread: bool = False):
        """Natural log of each target leaf's probability; with ``spread`` also both softmaxes whole."""
        cls, digit, n = target // DIGITS, target % DIGITS, np.arange(len(target))
        out, spreads = np.zeros(len(target)), []
        for rows, prior, at in ((class_rows, self.log_class[None], cls), (leaf_rows, self.log_leaf.take(cls, axis=0), digit)):
            logits = self.weights.take(rows[0], axis=0)
            logits += prior
            for r in rows[1:]:
                logits += self.weights.take(r, axis=0)
            np.exp(logits, out=logits)
            total = logits.sum(axis=1)
            out += np.log(np.maximum(logits[n, at], 1e-30)) - np.log(total)
            if spread:
                logits /= total[:, None]
                spreads.append(logits)
        return (out, spreads) if spread else out


def windows(tokens: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]]:
    """(text, target leaf, rows of the class softmax, rows of the leaf softmax) of the known tokens, a run at a time.

    ``tokens`` are those of texts that begin at ``starts``; tokens before a text's first are START.
    """
    for a in range(0, len(tokens), TOKENS_AT_ONCE):
        at = np.arange(a, min(a + TOKENS_AT_ONCE, len(tokens)))
        text = np.searchsorted(starts, at, "right") - 1
        keep = tokens[at] & UNKNOWN == 0
        at, text = at[keep], text[keep]
        place = at - starts[text]
        back = [np.where(place >= k, tokens[np.maximum(at - k, 0)] & ~np.uint16(UNKNOWN), START).astype(np.uint32) for k in (1, 2, 3)]
        leaf = [np.where(b == START, b, b & np.uint32(LEAVES - 1)) for b in back]
        values = [back[0], leaf[0] * np.uint32(1025) + leaf[1], leaf[1], leaf[2]]
        target = (tokens[at] & np.uint16(LEAVES - 1)).astype(np.int64)
        cls = (target // DIGITS).astype(np.uint32)
        class_rows, leaf_rows = [], []
        for f, v in enumerate(values):
            class_rows.append(((v * _MIX_CLASS[f]) >> np.uint32(20)) + np.uint32(f * CLASS_ROWS))
            bucket = (((v * _MIX_LEAF[f]) >> np.uint32(16)) * np.uint32(LEAF_ROWS)) >> np.uint32(16)
            leaf_rows.append(bucket + (cls + np.uint32(f * DIGITS)) * np.uint32(LEAF_ROWS) + np.uint32(FEATURES * CLASS_ROWS))
        yield text, target, class_rows, leaf_rows


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with their tokens, and where each row begins; every row has a token."""
    sizes = batch.column(batch.schema.get_field_index("n_tokens")).to_numpy()
    for part in slices(batch, sizes, DOCS_AT_ONCE_TOKENS):
        n = part.column(part.schema.get_field_index("n_tokens")).to_numpy()
        yield part, np.frombuffer(b"".join(part.column(part.schema.get_field_index("tokens")).to_pylist()), "<u2"), np.cumsum(n) - n


def _take_expected(table: np.ndarray, runs: list[tuple]) -> None:
    """Subtract from ``table`` (digit x row) the softmaxes of runs (class rows, leaf rows, class softmax, leaf softmax), each added up by row."""
    for kind, base, width in ((0, 0, CLASS_ROWS), (1, FEATURES * CLASS_ROWS, DIGITS * LEAF_ROWS)):
        spread = np.concatenate([run[2 + kind] for run in runs]).T.astype(np.float64, order="C")
        for f in range(FEATURES):
            start = base + f * width  # a feature's rows lie together
            at = np.concatenate([run[kind][f] for run in runs]).astype(np.int64) - start
            for k in range(DIGITS):
                table[k, start : start + width] -= np.bincount(at, spread[k], width)


def _sums(rows: DataFrame, model: Maxent | None) -> np.ndarray:
    """What every row of weights met as targets over all of ``rows``, less what ``model`` expected there."""
    kept = rows.sparkSession.sparkContext.broadcast(model) if model else None  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, model = np.zeros((DIGITS, ROWS)), kept.value if kept else None
        runs, waiting = [], 0
        for batch in batches:
            for _, tokens, starts in _tokens(batch):
                cells = []
                for _, target, class_rows, leaf_rows in windows(tokens, starts):
                    cls, digit = target // DIGITS, target % DIGITS
                    cells += [cls * ROWS + r for r in class_rows] + [digit * ROWS + r for r in leaf_rows]
                    if model:
                        runs.append((class_rows, leaf_rows, *model.log_probability(class_rows, leaf_rows, target, True)[1]))
                        waiting += len(target)
                        if waiting >= SPREADS_AT_ONCE:
                            _take_expected(table, runs)
                            runs, waiting = [], 0
                if cells:
                    table += np.bincount(np.concatenate(cells), minlength=DIGITS * ROWS).reshape(DIGITS, ROWS)
        if runs:
            _take_expected(table, runs)
        at = np.flatnonzero(table.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(table[k, at].astype(np.float32)) for k in range(DIGITS))], names=["row", *names])

    names = [f"v{k}" for k in range(DIGITS)]
    cells = rows.select("n_tokens", "tokens").mapInArrow(run, "row int, " + ", ".join(f"{v} float" for v in names))
    sums = cells.groupBy("row").agg(*[F.sum(v).cast("float").alias(v) for v in names]).toPandas()
    if kept:
        kept.destroy()
    table = np.zeros((ROWS, DIGITS), np.float32)
    table[sums["row"].to_numpy()] = sums[names].to_numpy()
    return table


def train(rows: DataFrame, leaf_mass: np.ndarray, rates: tuple[float, ...] = RATES) -> Maxent:
    """Weights from coded training texts: one iterative-scaling step on all, then one pass over all, a gradient update for each rate.

    The texts are dealt to as many parts as there are rates by their ``slice``, so each is in just one update. A weight moves by (met - expected) over
    what the part should hold of it (its share of all training tokens, or of the unigram expectation if that is larger) and a
    prior count, times the rate. The driver holds the weights, whose number is fixed. An update's tasks read some files
    each, so that fewer hand in sums.
    """
    model = Maxent(leaf_mass, np.zeros((ROWS, DIGITS), np.float32))
    prior = model.row_priors()
    met = _sums(rows, None)
    unigram = met.sum(axis=1, keepdims=True) * prior
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(prior > 0, (met + PRIOR_COUNT * prior) / (unigram + PRIOR_COUNT * prior), 1.0)
    model.weights = (np.log(ratio) / FEATURES).astype(np.float32)
    parts = max(1, len(rates))
    scale = np.maximum(met, unigram) / parts + PRIOR_COUNT
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, len(rows.inputFiles()) // FILES_A_TASK)
    for i, rate in enumerate(rates):
        part = rows.where(F.col("slice") % parts == i)
        step = rate * _sums(part.coalesce(tasks), model) / scale
        model.weights = np.clip(model.weights + np.clip(step, -1, 1), -8, 8).astype(np.float32)
    return model


def _encode(docs: DataFrame, key: str, text: str, held_out: Column) -> DataFrame:
    """Documents as codes of their block's words, and the blocks' words with how often training texts hold them."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), held_out.alias("held_out"), F.col(text).alias("text"))
    schema = f"block long, key {kind}, held_out boolean, slice int, codes binary, hashes binary, endings binary, trained binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in code_blocks(batches, "text", split_words):
            n = block.rows.num_rows
            held = block.rows["held_out"].combine_chunks()
            weights = np.repeat(~held.to_numpy(zero_copy_only=False), block.counts)
            trained = np.bincount(block.codes[weights], minlength=len(block.items)).astype(np.int64)
            hashes, endings = word_facts(block.items)
            number = lambda size, block=block: pa.array(np.full(size, block.number))
            fields = pa.schema([("block", pa.int64()), ("key", block.rows["key"].type), ("held_out", pa.bool_()), ("slice", pa.int32()), *((c, pa.binary()) for c in ("codes", "hashes", "endings", "trained"))])
            found = {"block": number(1), "hashes": _bytes(hashes), "endings": _bytes(endings), "trained": packed(trained, np.array([len(trained)]))}
            yield record(found, fields, 1)
            coded = {"block": number(n), "key": block.rows["key"].combine_chunks(), "held_out": held, "slice": pa.array(np.arange(n)), "codes": packed(block.codes, block.counts)}
            yield record(coded, fields, n)

    return rows.mapInArrow(run, schema)


def _bytes(values: np.ndarray) -> pa.Array:
    return pa.array([values.tobytes()], pa.binary())


def _buckets(coded: DataFrame, buckets: int) -> DataFrame:
    """The blocks' dictionaries by ranges of the hash: (block, bucket, hashes, endings, trained), without empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, hashes, endings, trained in zip(*batch.columns, strict=True):
                order, hashes = _by_hash(hashes.as_py())
                endings, trained = np.frombuffer(endings.as_py(), np.int16)[order], unpacked(pa.array([trained.as_py()]))[0][order]
                bucket = _bucket_of(hashes, buckets)
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                edges = np.append(first, len(bucket))
                columns = [pa.array(np.full(len(first), number.as_py())), pa.array(bucket[first]), raw_binary(hashes, 8 * edges), raw_binary(endings, 2 * edges), packed(trained, np.diff(edges))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "bucket", "hashes", "endings", "trained"])

    rows = coded.where("hashes IS NOT NULL").select("block", "hashes", "endings", "trained")
    return rows.mapInArrow(run, "block long, bucket long, hashes binary, endings binary, trained binary")


def _by_hash(hashes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The order of a block's words by hash, and the hashes in it."""
    values = np.frombuffer(hashes, np.uint64)
    order = np.argsort(values, kind="stable")
    return order, values[order]


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _counted(parts: DataFrame) -> DataFrame:
    """For each part of a dictionary its words' counts in all training texts; for each bucket, with a null block, sums by ending and its most frequent words.

    A bucket holds about BUCKET_ENTRIES entries, as hashes are even and a word has one entry for each block.
    """
    total = "array<long>"
    schema = f"block long, bucket long, counts binary, n {total}, words {total}, top {total}, top_ending {total}, top_n {total}"

    def count(group: pa.Table) -> pa.Table:
        hashes, endings = (np.frombuffer(b"".join(group[c].to_pylist()), kind) for c, kind in (("hashes", np.int64), ("endings", np.int16)))
        trained, sizes = unpacked(group["trained"].combine_chunks())
        words, at, entry = np.unique(hashes, return_index=True, return_inverse=True)
        n = np.bincount(entry, trained, len(words)).astype(np.int64)
        met, ending = n > 0, endings[at].astype(np.int64)
        top = np.lexsort((words, -n))[: FREQUENT - 1]
        top = top[n[top] > 0]
        edges = 8 * np.concatenate([[0], np.cumsum(sizes)])
        long = pa.list_(pa.int64())
        fields = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("counts", pa.binary()), *((c, long) for c in ("n", "words", "top", "top_ending", "top_n"))])
        sums = {"bucket": group["bucket"].combine_chunks()[:1], "n": one_list(np.bincount(ending, n, ENDINGS).astype(np.int64)), "words": one_list(np.bincount(ending, met, ENDINGS).astype(np.int64)), "top": one_list(words[top]), "top_ending": one_list(ending[top]), "top_n": one_list(n[top])}
        found = {"block": group["block"].combine_chunks(), "bucket": group["bucket"].combine_chunks(), "counts": raw_binary(n[entry], edges)}
        return pa.Table.from_batches([record(sums, fields, 1), record(found, fields, len(group))])

    return parts.groupBy("bucket").applyInArrow(count, schema)


def _prepare(coded: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per document its unigram sums and its tokens, the end included."""
    kind = coded.schema["key"].dataType.simpleString()
    documents = coded.where("codes IS NOT NULL").select("block", "key", "held_out", "slice", "codes")

    def read(row: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        if row.num_rows:
            get = lambda c: row.column(row.schema.get_field_index(c))[0].as_py()
            hashes, endings = np.frombuffer(get("hashes"), np.int64), np.frombuffer(get("endings"), np.int16)
            order, _ = _by_hash(get("hashes"))
            counts = np.empty(len(order), np.int64)
            counts[order] = np.frombuffer(b"".join(c["counts"] for c in sorted(get("found") or [], key=lambda c: c["bucket"])), np.int64)
        else:
            hashes, endings, counts = np.empty(0, np.int64), np.empty(0, np.int16), np.empty(0, np.int64)
        leaves = vocabulary.leaves(hashes, endings)
        facts = (leaves + np.where(counts > 0, 0, UNKNOWN) + ((hashes & 31) << HASH_BITS), vocabulary.base(counts), vocabulary.inner(counts, leaves), counts > 0)
        # codes without gaps, then the end of a text
        end_count = np.array([vocabulary.docs])
        end = (np.array([0 if vocabulary.docs else UNKNOWN]), vocabulary.base(end_count), vocabulary.inner(end_count, np.array([0])), end_count > 0)
        return tuple(np.concatenate([f, e]) for f, e in zip(facts, end, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for facts, part in by_block(batches, read):
            get = lambda c, part=part: part.column(part.schema.get_field_index(c))
            tokens, base, inner, known = facts or read(part.slice(0, 0))
            codes, n = unpacked(get("codes"))
            n = n + 1
            ends = np.cumsum(n)
            flat = np.full(ends[-1], len(tokens) - 1)
            word = np.ones(len(flat), bool)
            word[ends - 1] = False
            flat[word] = codes
            doc = np.repeat(np.arange(len(n)), n)
            total = lambda values, doc=doc, flat=flat, n=n: pa.array(np.bincount(doc, values[flat], len(n)))
            columns = [get("key"), get("held_out"), get("slice"), pa.array(n.astype(np.int64)), total(known).cast(pa.int64()), total(base), total(inner), raw_binary(tokens.astype("<u2")[flat], 2 * np.concatenate([[0], ends]))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "held_out", "slice", "n_tokens", "n_known", "base_score", "inner", "tokens"])

    schema = f"key {kind}, held_out boolean, slice int, n_tokens long, n_known long, base_score double, inner double, tokens binary"
    found = counts.where("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("bucket", "counts")).alias("found"))
    dictionaries = coded.where("hashes IS NOT NULL").select("block", "hashes", "endings").join(found, "block", "left")
    return reunite(documents, dictionaries).mapInArrow(run, schema)


def _score(rows: DataFrame, model: Maxent) -> DataFrame:
    """Add up each document's model probability (log10)."""
    kept = rows.sparkSession.sparkContext.broadcast(model)  # of fixed size
    schema = rows.select("key", "held_out", "n_tokens", "n_known", "base_score").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, tokens, starts in _tokens(batch):
                scores = part.column(part.schema.get_field_index("inner")).to_numpy().copy()
                for text, target, class_rows, leaf_rows in windows(tokens, starts):
                    scores += np.bincount(text, kept.value.log_probability(class_rows, leaf_rows, target), len(scores)) / np.log(10)
                yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(scores)], names=[*schema.names, "score"])

    out = rows.select(*schema.names, "inner", "tokens")
    return out.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", score double")


def is_held_out(key: Column) -> Column:
    """Rows that never train: crc32 of the key as text leaves 2 when divided by 7. A null key trains."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score_texts(docs: DataFrame, key: str, text: str, held_out: Column | None = None, rates: tuple[float, ...] = RATES) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row's whole text.

    Learns from the texts of the rows that are not held out: counts of all their words, weights from all of
    them. ``score`` and ``base_score`` are log10 probabilities of the text with its end. A null or
    empty text is its end alone. Keys may be null or repeat, every row counts; texts of any length are one row's work, in
    runs of tokens; other columns are not read. Without training rows every token is unknown, with
    probability 1 in both. An empty table gives an empty result. Words are told apart by a 64-bit hash.

    Texts are read once and travel once, as codes; the words' counts reach them through the blocks'
    dictionaries, which are dealt by ranges of the hash, counted and sent back. The driver gets a row for each leaf and one for each row of weights, whose numbers are fixed.
    """
    held_out = is_held_out(F.col(key)) if held_out is None else held_out
    coded = staged(_encode(docs, key, text, held_out), "maxent-codes")
    entries = coded.where("hashes IS NOT NULL").agg(F.sum(F.octet_length("hashes") / 8)).first()[0] or 0
    counted = staged(_counted(_buckets(coded, max(1, -(-int(entries) // BUCKET_ENTRIES)))), "maxent-counts")
    vocabulary = _vocabulary(counted, coded.where("codes IS NOT NULL AND NOT held_out").count())
    rows = staged(_prepare(coded, counted, vocabulary), "maxent-tokens")
    model = train(rows.where("NOT held_out"), vocabulary.leaf_mass, rates)
    out = _score(rows, model).withColumn("train_tokens", F.lit(vocabulary.tokens).cast("long"))
    return out.select(F.col("key").alias(key), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
