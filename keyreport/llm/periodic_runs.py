"""Periodic runs in the word sequence of whole texts, by difference-cover extensions.

A run is a stretch of consecutive words with smallest period q (words q apart are equal)
and at least max(``min_length``, 2 q) words that no neighbouring word extends with that
period.

* Words get exact numbers per chunk of texts (a dictionary of their bytes). Texts of a
  chunk stand in one sequence with a number of its own between them, so nothing extends
  from one text into the next.
* ``Extension`` answers how far two places agree. Only suffixes at places in a difference
  cover modulo 13 (4 of 13) are sorted, by doubling block ranks. For any two places there
  is a shift of at most 12 words after which both are in the cover; these words are
  compared directly, and most pairs differ there. From the sampled places on, the answer
  is a range minimum over the common prefixes of sorted neighbours (sparse table). The
  same on the reversed sequence gives extensions to the left.
* A run of period q holds two of the grid places 0, q, 2q, ... next to each other. So all
  grid neighbours of all periods are listed (n/1 + n/2 + ..., as n log n), those with
  unequal words go, and the others' extensions to both sides give the run if they add
  up to q. A stretch found with several periods has the smallest one.

A word goes from the kept text if any run contains it after that run's first q words.

The work is a scalar Arrow function of the text: no shuffle, and the other columns stay in
the JVM. A task holds the texts of one Arrow batch and the tables of about
``CHUNK_BYTES`` of text, or of one longer text; grid places are taken ``PAIRS`` at a time.

Defined results: text null or without words: 0 words, no runs, empty kept text. Rows that
repeat an id or all columns are judged each. A null id changes nothing. An empty table
gives no rows. Input columns stay inside the struct column ``record``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyreport.llm.common import CHUNK_BYTES, NOT_SPACE, table, words
from keyreport.llm.queries import query

MIN_LENGTH = 12
# Differences of these residues give every residue modulo the modulus.
MODULUS, COVER = 13, (0, 1, 3, 9)
# Grid places handled at once.
PAIRS = 1 << 18

_SLOT = np.full(MODULUS, -1)
_SLOT[list(COVER)] = np.arange(len(COVER))
_SHIFT = np.array([[next(d for d in range(MODULUS) if _SLOT[(a + d) % MODULUS] >= 0 and _SLOT[(b + d) % MODULUS] >= 0)
                    for b in range(MODULUS)] for a in range(MODULUS)])


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


class Extension:
    """Common extensions in a sequence of positive numbers whose last one is unique."""

    def __init__(self, sequence: np.ndarray):
        self.n = len(sequence)
        self.s = np.concatenate([sequence.astype(np.int64), np.zeros(2 * MODULUS, np.int64)])
        blocks = -(-self.n // MODULUS)
        place = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()
        place = place[place < self.n]
        levels = self._levels(place)
        self.rank = levels[-1]
        self.minima = self._sparse(self._neighbours(place, levels))

    def _levels(self, place: np.ndarray) -> list[np.ndarray]:
        """Ranks of the sampled places by their next 13, 26, 52, ... numbers, up to distinct ones."""
        bits = int(self.s.max()).bit_length()
        at_once = max(1, (63 - len(place).bit_length()) // bits)
        rank, k = np.zeros(len(place), np.int64), 0
        while k < MODULUS:
            for _ in range(min(at_once, MODULUS - k)):
                rank = (rank << bits) | self.s[place + k]
                k += 1
            rank = _ranks(rank)
        levels, step = [rank], len(COVER)
        while rank.max() + 1 < len(rank):
            after = np.zeros(len(rank), np.int64)
            after[:-step] = rank[step:] + 1
            rank = _ranks(rank * (len(rank) + 1) + after)
            levels.append(rank)
            step *= 2
        return levels

    def _neighbours(self, place: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Length of the common prefix of each sorted suffix and the next."""
        order = np.empty(len(place), np.int64)
        order[self.rank] = np.arange(len(place))
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 2, -1, -1):
            ranks, step = levels[level], len(COVER) << level
            inside = np.flatnonzero(np.maximum(a, b) < len(place))
            same = inside[ranks[a[inside]] == ranks[b[inside]]]
            a[same] += step
            b[same] += step
            common[same] += MODULUS << level
        x, y = place[order[:-1]] + common, place[order[1:]] + common
        alive = np.arange(len(x))
        for k in range(MODULUS):
            alive = alive[self.s[x[alive] + k] == self.s[y[alive] + k]]
            common[alive] += 1
        return common

    @staticmethod
    def _sparse(values: np.ndarray) -> list[np.ndarray]:
        """``out[j][i]``: the minimum of 2^j values from i on."""
        out = [values.astype(np.int32)]
        while (2 << (len(out) - 1)) <= len(values):
            step = 1 << (len(out) - 1)
            out.append(np.minimum(out[-1][:-step], out[-1][step:]))
        return out

    def _minimum(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of the values in [low, high), which isn't empty."""
        out = np.empty(len(low), np.int64)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for j in np.unique(level):
            at = np.flatnonzero(level == j)
            out[at] = np.minimum(self.minima[j][low[at]], self.minima[j][high[at] - (1 << j)])
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers agree from places ``i`` and ``j`` on (i <> j, elementwise)."""
        shift = _SHIFT[i % MODULUS, j % MODULUS]
        out = np.zeros(len(i), np.int64)
        alive = np.arange(len(i))
        for k in range(MODULUS - 1):
            far = shift[alive] <= k
            same = far | (self.s[i[alive] + k] == self.s[j[alive] + k])
            out[alive[same & ~far]] += 1
            alive = alive[same]
        i, j = i[alive] + shift[alive], j[alive] + shift[alive]
        a, b = (self.rank[x // MODULUS * len(COVER) + _SLOT[x % MODULUS]] for x in (i, j))
        out[alive] += self._minimum(np.minimum(a, b), np.maximum(a, b))
        return out


def grid(first: np.ndarray, min_length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, period) of all grid places with a next one in their text, about ``PAIRS`` at a time;
    the words of text i are ``first[i]:first[i + 1]``."""
    size = np.diff(first)
    long = np.flatnonzero(size >= max(min_length, 2))
    periods = size[long] // 2
    owner = np.repeat(long, periods)
    q = np.arange(len(owner)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    count = (size[owner] - 1) // q
    total = np.cumsum(count)
    cut = 0
    while cut < len(q):
        end = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + PAIRS, "right")))
        c = count[cut:end]
        nth = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        period = np.repeat(q[cut:end], c)
        yield np.repeat(first[owner[cut:end]], c) + nth * period, period
        cut = end


def _smallest_periods(start: np.ndarray, end: np.ndarray, period: np.ndarray):
    """Each stretch once, with its smallest period; sorted by start, then period."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])]) if len(start) else np.zeros(0, bool)
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs_of(numbers: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH):
    """(start, end, period) of the runs of all texts, as places in ``numbers`` (positive;
    the words of text i are ``first[i]:first[i + 1]``)."""
    texts = len(first) - 1
    # The numbers between the texts are larger than any word's, each its own.
    sequence = np.insert(numbers.astype(np.int64), first, numbers.max(initial=0) + 1 + np.arange(texts + 1))
    moved = np.repeat(np.arange(texts) + 1, np.diff(first))
    ahead = back = None
    found = [np.zeros((3, 0), np.int64)]
    for word, q in grid(first, min_length):
        x = word + moved[word]
        same = np.flatnonzero(sequence[x] == sequence[x + q])
        if not len(same):
            continue
        if ahead is None:
            ahead, back = Extension(sequence), Extension(sequence[::-1].copy())
        word, x, q = word[same], x[same], q[same]
        right = ahead.common(x, x + q)
        mirror = len(sequence) - x
        left = back.common(mirror, mirror - q)
        hit = (left + right >= q) & (left + right + q >= min_length)
        found.append(np.stack(_smallest_periods(word[hit] - left[hit], word[hit] + q[hit] + right[hit], q[hit])))
    return _smallest_periods(*np.concatenate(found, axis=1))


RESULT = "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, kept_text: string>"


def _judged(texts: pa.Array, min_length: int) -> pa.Array:
    w = words(texts, NOT_SPACE, lanes=0)
    n, first = len(w.start), w.first
    letters = w.data[NOT_SPACE[w.data] == 1]
    offsets = np.concatenate([[0], np.cumsum(w.end - w.start)]).astype(np.int64)
    each = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    numbers = each.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    start, end, period = runs_of(numbers, first, min_length)
    gone = np.zeros(n + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, end, -1)
    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    lists = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(kept, first)), each.take(pa.array(kept)))
    text = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string()).cast(pa.string())
    cut = np.searchsorted(start, first)
    owner = np.repeat(first[:-1], np.diff(cut))
    runs = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(start - owner), pa.array(end - start), pa.array(period)], names=["start", "length", "period"]))
    return pa.StructArray.from_arrays([pa.array(np.diff(first)), runs, text], names=["n_words", "runs", "kept_text"])


def judge(min_length: int = MIN_LENGTH):
    """An Arrow function from texts to ``RESULT``."""
    @F.arrow_udf(RESULT)
    def call(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            group = np.cumsum(size) // CHUNK_BYTES
            cut = [0, *(np.flatnonzero(np.diff(group)) + 1), len(texts)]
            parts = [_judged(texts.slice(a, b - a), min_length) for a, b in itertools.pairwise(cut)]
            yield pa.concat_arrays(parts)

    return call


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, text_col: str = "text") -> DataFrame:
    """``record, n_words, runs, kept_text`` per row of ``docs``: runs as (start, length,
    period) by start, then period; kept words joined by one space."""
    rows = docs.select(F.struct("*").alias("record"), judge(min_length)(F.col(text_col).cast("string")).alias("found"))
    return rows.select("record", "found.n_words", "found.runs", "found.kept_text")


def longest_run(runs: Column) -> Column:
    """The longest run, the first of several, as a struct; null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(best.isNotNull(), F.struct((-best["s"]).alias("start"), best["length"].alias("length"),
                                             (-best["p"]).alias("period")))


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` where a tenth of the texts, chosen and cut by a hash of the id, becomes
    periodic from some word on: the registered query's input. Null ids change nothing."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    all_words = F.filter(F.split(text_col, "[\\x20\\x09-\\x0D]+"), lambda x: x != "")

    def repeated(w: Column) -> Column:
        # w is evaluated once per row.
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(
            F.get(w, (a + (i - a) % p).cast("int")))), " ")

    text = F.when(h % 10 == 0, F.get(F.transform(F.array(all_words), repeated), 0)).otherwise(F.col(text_col))
    return docs.withColumn(text_col, text)


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    found = found.withColumn("best", longest_run(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "record.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"))
