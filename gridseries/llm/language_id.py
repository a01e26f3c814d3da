"""Language identification of whole texts, span by span.

Script ranges narrow the candidate languages of a word, character n-grams score
it for each of them, and a Viterbi path over the words with a penalty for every
change of language labels the spans of a mixed text. A word counts for its span's
language only if its n-grams are as likely there as that language's own usually are,
so foreign scripts and languages that were not learned count for none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.common import give_back, mix64, worker_state

#: Words of texts up to Latin Extended-B, whose only number signs that count as word characters are these six.
LATIN_WORD = re.compile(r"[^\W\d_\u00b2\u00b3\u00b9\u00bc-\u00be]+")
BEYOND_LATIN = re.compile(r"[^\0-\u024f]")
#: Words of any text: letters with their marks.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: First and last code point of the blocks that decide a script.
SCRIPT_RANGES = [
    ("latin", 0x41, 0x24F),
    ("greek", 0x370, 0x3FF),
    ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F),
    ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x77F),
    ("devanagari", 0x900, 0x97F),
    ("bengali", 0x980, 0x9FF),
    ("tamil", 0xB80, 0xBFF),
    ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x3FFFF),
]
LAST_LATIN = "\u024f"
#: Scripts written without spaces: a run of letters is cut into pieces of UNSPACED_PIECE.
UNSPACED = {"han", "kana", "thai"}
UNSPACED_PIECE = 4
SCRIPTS = sorted({name for name, _, _ in SCRIPT_RANGES} | {"other"})
_STARTS = np.array([a for _, a, _ in SCRIPT_RANGES])
_ENDS = np.array([b for _, _, b in SCRIPT_RANGES])
_NUMBER = np.array([SCRIPTS.index(name) for name, _, _ in SCRIPT_RANGES])

GRAM_BUCKETS = 1 << 15
GRAM_SIZES = (1, 2, 3)
#: A language is a candidate for a script that holds at least this share of its training letters.
SCRIPT_SHARE = 0.02
SWITCH_PENALTY = 8.0
#: A word is a language's own from the mean log-probability of that language's n-grams, less so many deviations of one, on.
EVIDENCE_DEVIATIONS = 0.5
#: Training reads about this many labelled rows at most, an even share of each language, picked by a hash of the key.
MAX_TRAINING_ROWS = 6000
#: With so many languages that the share is smaller, each still trains on about so many rows.
LEAST_ROWS = 200
HASH_RANGE = 1 << 30
CACHED_WORDS = 200_000
WORDS_AT_ONCE = 400_000
WORDS_SCORED_AT_ONCE = 50_000


def words_of(text: str) -> list[str]:
    """Words of lower-case text: runs of letters and their marks, cut where the script changes and, in scripts without spaces, into short pieces."""
    if text.isascii() or not BEYOND_LATIN.search(text):
        return LATIN_WORD.findall(text)
    out: list[str] = []
    for word in WORD.findall(text):
        if max(word) <= LAST_LATIN:
            out.append(word)
        else:
            out += _pieces(word)
    return out


def _pieces(word: str) -> list[str]:
    """The word's runs of one script; marks and letters of no listed script belong to the run before them, or to the first."""
    scripts = letter_scripts(word)
    listed = np.flatnonzero(scripts != SCRIPTS.index("other"))
    if not len(listed):
        return [word]
    cuts = listed[1:][np.diff(scripts[listed]) != 0]
    edges = [0, *cuts.tolist(), len(word)]
    out = []
    for a, b in zip(edges, edges[1:], strict=False):
        step = UNSPACED_PIECE if SCRIPTS[scripts[listed[np.searchsorted(listed, a)]]] in UNSPACED else b - a
        out += [word[i : min(i + step, b)] for i in range(a, b, step)]
    return out


def letter_scripts(word: str) -> np.ndarray:
    """Number of the script of each code point."""
    points = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.int64)
    at = np.searchsorted(_STARTS, points, "right") - 1
    inside = (at >= 0) & (points <= _ENDS[at])
    return np.where(inside, _NUMBER[at], SCRIPTS.index("other"))


def word_script(word: str) -> int:
    """Number of the script that most letters of the word are in; the lowest number on a tie."""
    if word.isascii():
        return SCRIPTS.index("latin")
    return int(np.bincount(letter_scripts(word)).argmax())


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character n-grams of lower-case words with a space at either end.

    Returns the bucket of the gram of each size that starts at each place of the
    words joined by spaces (size x place), whether there is one, and the place where
    each word (with the space before it) starts.
    """
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    space = points == 32
    buckets, there = np.zeros((len(GRAM_SIZES), len(points)), np.int64), np.zeros((len(GRAM_SIZES), len(points)), bool)
    for row, size in enumerate(GRAM_SIZES):
        n = len(points) - size + 1
        mixed = np.full(n, size, np.uint64)
        for k in range(size):
            mixed = mix64(mixed * np.uint64(0x9E3779B97F4A7C15) + points[k : n + k])
        buckets[row, :n] = mixed % np.uint64(GRAM_BUCKETS)
        inner = range(1, size - 1) if size > 1 else (0,)
        there[row, : n - (size > 1)] = True
        there[row, n - 1 : n] = size > 1  # the last place starts the space after the last word alone
        for k in inner:  # a space inside parts two words; a space alone is no gram
            there[row, :n] &= ~space[k : n + k]
    return buckets, there, np.flatnonzero(space)[:-1]


class WordNumbers(dict):
    """word -> number, in order of first use; ``new`` lists the words numbered since it was last emptied."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


@dataclass
class LanguageModel:
    """Languages, their n-gram log-probabilities (language x bucket), which scripts each is written in, and the least mean log-probability of its own words."""

    languages: list[str]
    grams: np.ndarray
    in_script: np.ndarray
    floors: np.ndarray
    penalty: float = SWITCH_PENALTY
    numbers: WordNumbers = field(default_factory=WordNumbers)
    scores: np.ndarray | None = None
    own: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"numbers": WordNumbers(), "scores": None, "own": None}

    def score_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(score, own) of each word for each language.

        The score is the evidence in nats, relative to the mean of the candidates; far below
        them for the others. ``own`` marks candidates in which the word is as likely as their own words.
        """
        if not words:
            return np.zeros((0, len(self.languages)), np.float32), np.zeros((0, len(self.languages)), bool)
        buckets, there, starts = word_grams(words)
        table = self.grams.T
        total = np.zeros((buckets.shape[1], len(self.languages)), np.float32)
        for row, mask in zip(buckets, there, strict=True):
            total += table[row] * mask[:, None]
        total = np.add.reduceat(total, starts, axis=0)
        n_grams = np.add.reduceat(there.sum(axis=0), starts)
        scripts = np.full(len(words), SCRIPTS.index("latin"))
        for i, word in enumerate(words):
            if not word.isascii() and max(word) > LAST_LATIN:
                scripts[i] = word_script(word)
        candidates = self.in_script.T[scripts]
        own = candidates & (total >= n_grams[:, None] * self.floors.astype(np.float32))
        n = candidates.sum(axis=1, keepdims=True)
        total /= len(GRAM_SIZES)
        total -= (total * candidates).sum(axis=1, keepdims=True) / np.maximum(n, 1)
        return np.where(n == 0, 0, np.where(candidates, np.clip(total, -20, 20), -30)).astype(np.float32), own

    def _scored(self) -> tuple[np.ndarray, np.ndarray]:
        """Score and ``own`` of every numbered word, new ones first scored together."""
        new = self.numbers.new
        parts = [self.score_words(new[i : i + WORDS_SCORED_AT_ONCE]) for i in range(0, max(1, len(new)), WORDS_SCORED_AT_ONCE)]
        self.numbers.new = []
        if self.scores is not None:
            parts.insert(0, (self.scores, self.own))
        self.scores, self.own = (np.concatenate(p) for p in zip(*parts, strict=True))
        return self.scores, self.own

    def label(self, texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """(words, language number of each, whether it is that language's own) of every text, in order."""
        at = 0
        while at < len(texts):
            if len(self.numbers) > CACHED_WORDS:
                self.numbers, self.scores, self.own = WordNumbers(), None, None
            group, held = [], 0
            while at < len(texts) and held < WORDS_AT_ONCE:
                words = words_of(texts[at].lower()) if texts[at] else []
                group.append((words, np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))))
                held += len(words)
                at += 1
            scores, own = self._scored()
            paths = viterbi([ids for _, ids in group], scores, self.penalty)
            yield from ((words, path, own[ids, path]) for (words, ids), path in zip(group, paths, strict=True))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Each text's language (most letters of its own words in its spans; the first by name on a tie) and their share of all letters.

        A text without any such word has the language of most letters in spans, with share 0.
        """
        names, shares = [], []
        for words, path, own in self.label(texts):
            if not words:
                names.append("und")
                shares.append(0.0)
                continue
            sizes = np.fromiter(map(len, words), np.float64, len(words))
            letters = np.bincount(path, sizes * own, len(self.languages))
            shares.append(float(letters.max() / sizes.sum()))
            names.append(self.languages[int((letters if letters.any() else np.bincount(path, sizes, len(self.languages))).argmax())])
        return names, shares


def viterbi(texts: list[np.ndarray], scores: np.ndarray, penalty: float) -> list[np.ndarray]:
    """Best language path of every text, for word numbers into ``scores`` (word x language).

    All texts step together, the longest first, so that the ones still running
    are a prefix; each step costs a few vector operations, and the path back takes one bit
    of choice for each word and language.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    ends = np.cumsum(lengths[order])
    starts = ends - lengths[order]
    flat = np.concatenate([texts[i] for i in order]) if len(texts) else np.empty(0, np.int32)
    longest = int(lengths.max(initial=0))
    running = np.searchsorted(-lengths[order], -np.arange(longest), "left")
    n_lang = scores.shape[1]
    switched = np.zeros((len(flat), n_lang), bool)
    source = np.zeros(len(flat), np.int16)
    best = np.zeros((len(texts), n_lang), np.float32)
    for t in range(longest):
        n = running[t]
        at = starts[:n] + t
        if t:
            top = best[:n].argmax(axis=1)
            jump = best[np.arange(n), top][:, None] - penalty
            moved = jump > best[:n]
            switched[at] = moved
            source[at] = top
            best[:n] = np.where(moved, jump, best[:n])
        best[:n] += scores[flat[at]]
    path = np.zeros(len(flat), np.int16)
    now = best.argmax(axis=1).astype(np.int16)
    for t in range(longest - 1, -1, -1):
        n = running[t]
        at = starts[:n] + t
        path[at] = now[:n]
        if t:
            now[:n] = np.where(switched[at, now[:n]], source[at], now[:n])
    out: list[np.ndarray] = [np.empty(0, np.int16)] * len(texts)
    for k, i in enumerate(order):
        out[i] = path[starts[k] : ends[k]]
    return out


def train(docs: DataFrame, key: str, text: str, language: str, max_rows: int = MAX_TRAINING_ROWS) -> LanguageModel | None:
    """Fit on the rows of ``docs`` with a text and a language; None if there are none.

    Every language is learned: of each, up to an even share of ``max_rows`` (LEAST_ROWS where that
    is more), picked by a hash of the key. Counting is distributed; the driver gets
    one row count for each language and one count for each language and bucket.
    """
    lang = F.col(language).cast("string")
    known = docs.where(F.col(text).isNotNull() & F.col(language).isNotNull())
    rows_of = dict(known.groupBy(lang.alias("lang")).count().collect())
    if not rows_of:
        return None
    bound = max(max_rows // len(rows_of), LEAST_ROWS)
    shares = {name: int(bound / n * HASH_RANGE) for name, n in rows_of.items() if n > bound}
    place = F.pmod(F.xxhash64(F.lit("language"), F.col(key)), F.lit(HASH_RANGE))
    taken = F.lit(HASH_RANGE)
    if shares:
        by_name = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
        taken = F.coalesce(F.try_element_at(by_name, lang), taken)
    picked = known.where(place < taken)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("language_id", dict)  # other operators' caches make room
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words.setdefault(lang, Counter()).update(words_of(value.as_py().lower()))
        for lang, counted in words.items():
            total = np.zeros(GRAM_BUCKETS + len(SCRIPTS), np.int64)
            for word, times in counted.items():
                total[GRAM_BUCKETS + word_script(word)] += times * len(word)
            known, times = list(counted), np.array(list(counted.values()), np.int64)
            for i in range(0, len(known), WORDS_SCORED_AT_ONCE):
                buckets, there, starts = word_grams(known[i : i + WORDS_SCORED_AT_ONCE])
                owner = np.repeat(times[i : i + WORDS_SCORED_AT_ONCE], np.diff(starts, append=buckets.shape[1]))
                for row, mask in zip(buckets, there, strict=True):
                    total[:GRAM_BUCKETS] += np.bincount(row[mask], owner[mask], GRAM_BUCKETS).astype(np.int64)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(total[at])], names=["lang", "at", "n"])

    counts = picked.select(lang, text).mapInArrow(count, "lang string, at long, n long")
    rows = counts.groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    if not languages:
        return None
    table = np.zeros((len(languages), GRAM_BUCKETS + len(SCRIPTS)))
    table[rows["lang"].map(languages.index).to_numpy(), rows["at"].to_numpy()] = rows["n"]
    seen, scripts = table[:, :GRAM_BUCKETS], table[:, GRAM_BUCKETS:]
    grams = seen + 0.5
    totals = grams.sum(axis=1, keepdims=True)
    shares = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
    return LanguageModel(languages, np.log(grams / totals).astype(np.float32), shares >= SCRIPT_SHARE, own_floors(seen, totals))


def own_floors(seen: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """For each language the mean log-probability of its n-grams less EVIDENCE_DEVIATIONS deviations.

    Each occurrence is judged without itself, so a language of few rows gets the low floor that its new texts need.
    """
    share = seen / np.maximum(1, seen.sum(axis=1, keepdims=True))
    rest = np.log(np.maximum(seen - 0.5, 0.5) / totals)
    mean = (share * rest).sum(axis=1, keepdims=True)
    return mean[:, 0] - EVIDENCE_DEVIATIONS * np.sqrt((share * (rest - mean) ** 2).sum(axis=1)) - 1e-3


def predictor(model: LanguageModel | None):
    """A vectorised function text -> (lang_pred, score)."""
    # a small model travels with the function: languages x buckets floats
    kept: list[LanguageModel] = [model] if model else []

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker_state("language_id", dict)  # other operators' caches make room
        for batch in batches:
            names, shares = kept[0].predict(batch.tolist()) if kept else (["und"] * len(batch), [0.0] * len(batch))
            yield pd.DataFrame({"lang_pred": names, "score": shares})
            del batch, names, shares
            give_back()

    return predict


def is_held_out(key: Column) -> Column:
    """Rows that never train: crc32 of the key as text leaves 1 when divided by 3. A null key never trains either."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_on_rest(docs: DataFrame, key: str, text: str, language: str, max_rows: int = MAX_TRAINING_ROWS) -> LanguageModel | None:
    return train(docs.where(F.col(key).isNotNull() & ~is_held_out(F.col(key))), key, text, language, max_rows)


def identify(docs: DataFrame, key: str, text: str, language: str, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(key, held_out, lang_pred, score) of every row's whole text.

    Learns from text and language of the rows that are not held out; a
    prediction sees the text only. The score is the share of the letters in words
    of the predicted language's own, so it is low for scripts and languages that were not
    learned. ``und`` with score 0 for a null text, one without letters (number signs are none), or when no row has a
    language; an empty table gives an empty result. Very long texts are labelled whole, some words at a time. Keys may repeat or be null
    (such rows train nothing); other columns are not read. No shuffle but the counts'.
    """
    predict = predictor(train_on_rest(docs, key, text, language, max_rows))
    out = docs.select(F.col(key), is_held_out(F.col(key)).alias("held_out"), predict(F.col(text)).alias("p"))
    return out.select(key, "held_out", "p.lang_pred", "p.score")


def language_spans(docs: DataFrame, key: str, text: str, model: LanguageModel) -> DataFrame:
    """(key, span, lang, start_word, words): runs of words in one language, in order; none for a text without letters."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, (words, path, _) in enumerate(model.label(batch.column(1).to_pylist())):
                edges = np.flatnonzero(np.diff(path, prepend=-1)) if words else []
                ends = [*edges[1:], len(words)] if len(edges) else []
                rows += [(at, i, model.languages[path[a]], int(a), int(b - a)) for i, (a, b) in enumerate(zip(edges, ends, strict=True))]
            at, *rest = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
            arrays = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(rest, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "span", "lang", "start_word", "words"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, span int, lang string, start_word long, words long")
