"""Benchmark passages in documents, by a random-walk embedding and bit sampling.

Texts are sequences of lower-cased alphanumeric words; a character of a script that is
written without spaces is a word of its own. A random walk reads a sequence: at step j
it stands on word i, writes it, and moves on by a coin that depends on (repetition, j,
word). The written sequence embeds the edit distance: after an edit two walks meet again
soon, so near sequences have near embeddings in Hamming distance. Bit sampling keeps some
steps of the embedding, one or two apart; two windows collide in a repetition if they
agree in the sampled steps.

* Windows start at every word of an item and at every word of every document.
* How many steps are sampled follows from the exact distance: of an item of n words with
  k edits, the n - k words or more that stay lie in at most k + 1 unbroken stretches, so
  one of them has ``ceil((n - k) / (k + 1))`` words. With k the most edits that
  ``max_ratio`` allows, a window is sampled until it has written that many different
  places (``MOST_PLACES`` at most).
* A sample that windows of more than ``SHARED`` items have in common (a common phrase) is
  sampled further, until it is rarer or the window ends, so it doesn't lead to all of them.
* ``repetitions`` of each such class follow from the target ``recall``: simulated with a
  fixed seed on the driver for items at ``max_ratio``, with edits at random and evenly
  spread, which leaves no longer stretch than the bound.

Collisions are verified by the exact word edit distance between the whole item and
the best matching span around the position, once per item and window; an item is found
if that is at most ``max_ratio`` of its words. Items too short for an edit are found where
they stand whole. Items of equal words are searched once.

The benchmark is sent to the tasks in slices of at most ``SLICE_BYTES`` of text; a
larger one takes several passes. A worker builds a slice's index once. There is no
shuffle, and a task holds one chunk.

Defined results: texts or items that are null or have no words, or items of fewer than
``min_words`` words (none by default), give no row. Equal items under several ids each
give their row. Rows that repeat an id each give theirs. Other columns are ignored.
"""

from __future__ import annotations

import functools
import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyreport.llm.common import LOWER, U64, WORD_BYTES, chunks, mix, table, words
from keyreport.llm.queries import query

MIN_WORDS = 1
MAX_RATIO = 0.2
RECALL = 0.9999
# Different places that a window's sample has at most, and steps it may take.
MOST_PLACES, MOST_SAMPLES = 5, 40
# Items that may share a sample.
SHARED = 8
SLICE_BYTES = 8 << 20
# Characters of scripts written without spaces: Thai to Burmese, kana, ideographs.
UNSPACED = r"([\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}" \
    r"\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}])"
SCHEMA = "doc_id long, item_id long, item_words int, distance int, first_word long, last_word long, hits int"


def coins(rep: int, steps: int) -> np.ndarray:
    rng = np.random.default_rng(90_001 + rep)
    return rng.integers(1, 2**63, steps, dtype=np.int64).astype(U64) * U64(2) + U64(1)


def sampled(rep: int, places: int) -> list[int]:
    """The sampled steps of a repetition for windows of so many places."""
    rng = np.random.default_rng(70_001 + 64 * rep + places)
    return [0, *np.cumsum(rng.integers(1, 3, MOST_SAMPLES)).tolist()]


def places_for(size: int, max_ratio: float) -> int:
    """Length of the unbroken stretch that the allowed edits must leave, bounded."""
    most = most_edits(size, max_ratio)
    return min(MOST_PLACES, -(-(size - most) // (most + 1)))


class Known:
    """A set of 64-bit values with a fast first test."""

    def __init__(self, values):
        self.sorted = np.unique(np.array(values, dtype=U64))
        self.bits = np.zeros(1 << 16, dtype=bool)
        self.bits[(self.sorted >> U64(48)).astype(np.int64)] = True

    def holds(self, x: np.ndarray) -> np.ndarray:
        """Indices of the members among ``x``."""
        some = np.flatnonzero(self.bits[(x >> U64(48)).astype(np.int64)])
        if not len(self.sorted) or not len(some):
            return some[:0]
        at = np.minimum(np.searchsorted(self.sorted, x[some]), len(self.sorted) - 1)
        return some[self.sorted[at] == x[some]]


def _next(acc: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(acc * U64(0x9E3779B97F4A7C15) + word)


def most_edits(size: int, max_ratio: float) -> int:
    return int(max_ratio * size)


class Walks:
    """Index of the items' sampled walks; items: list of (ids, word hashes)."""

    def __init__(self, items: list[tuple], max_ratio: float, repetitions: dict[int, int]):
        self.items = items
        self.tables = []  # per class and repetition: (coins, steps, Known per step, terminals per step)
        words_of = [h for _, h in items]
        size = np.array([len(h) for h in words_of], dtype=np.int64)
        flat = np.concatenate([*words_of, np.zeros(1, U64)])
        first = np.concatenate([[0], np.cumsum(size)])
        need = np.array([places_for(n, max_ratio) for n in size.tolist()], dtype=np.int64)
        firsts = [np.zeros(0, U64)]
        for places in np.unique(need).tolist():
            mine = np.flatnonzero(need == places)
            item = np.repeat(mine, size[mine])
            anchor = np.arange(len(item)) - np.repeat(np.cumsum(size[mine]) - size[mine], size[mine])
            for rep in range(repetitions[places]):
                built = self._built(flat, first, item, anchor, places, rep)
                self.tables.append(built)
                firsts.append(built[2][0].sorted)
        self.first = Known(np.concatenate(firsts))

    @staticmethod
    def _built(flat, first, item, anchor, places, rep):
        steps = sampled(rep, places)
        coin = coins(rep, steps[-1] + 1)
        pos, end = first[item] + anchor, first[item + 1]
        acc, seen, before = flat[pos], np.ones(len(pos), dtype=np.int64), pos
        known, terminal = [], []
        for k, step in enumerate(steps):
            if k:
                for j in range(steps[k - 1], step):
                    with np.errstate(over="ignore"):
                        pos = np.minimum(pos + ((flat[pos] * coin[j]) >> U64(63)).astype(np.int64), end)
                # Walks that left their item ended with the step before.
                on = pos < end
                item, anchor, pos, end, acc, seen, before = (x[on] for x in (item, anchor, pos, end, acc, seen, before))
                acc = _next(acc, flat[pos])
                seen = seen + (pos != before)
                before = pos
            known.append(Known(acc))
            # Does the walk stay in its item up to the next sampled step?
            ahead, last = pos, k + 1 == len(steps)
            for j in range(step, step if last else steps[k + 1]):
                with np.errstate(over="ignore"):
                    ahead = np.minimum(ahead + ((flat[ahead] * coin[j]) >> U64(63)).astype(np.int64), end)
            ends = (ahead >= end) | last
            enough = seen >= places
            stops = (enough & (ends | (items_sharing(acc, item) <= SHARED))) | (ends & (anchor == 0))
            order = np.flatnonzero(stops)
            order = order[np.argsort(acc[order], kind="stable")]
            terminal.append((acc[order], item[order], anchor[order]))
            go = ~stops & ~ends
            item, anchor, pos, end, acc, seen, before = (x[go] for x in (item, anchor, pos, end, acc, seen, before))
            if not len(pos):
                break
        return coin, steps[:len(known)], known, terminal

    def candidates(self, h: np.ndarray):
        """(position, item, anchor) arrays of colliding windows over the flat words ``h``."""
        start = self.first.holds(h)
        longest = max((t[1][-1] for t in self.tables), default=0)
        h = np.concatenate([h, np.zeros(longest + 1, dtype=U64)])
        out = [np.zeros((3, 0), dtype=np.int64)]
        for coin, steps, known, terminal in self.tables:
            pos = start[known[0].holds(h[start])]
            cur, acc = pos, h[pos]
            for k, step in enumerate(steps):
                if k:
                    for j in range(steps[k - 1], step):
                        with np.errstate(over="ignore"):
                            cur = cur + ((h[cur] * coin[j]) >> U64(63)).astype(np.int64)
                    acc = _next(acc, h[cur])
                    stay = known[k].holds(acc)
                    pos, cur, acc = pos[stay], cur[stay], acc[stay]
                if not len(pos):
                    break
                final, item, anchor = terminal[k]
                left, right = np.searchsorted(final, acc, "left"), np.searchsorted(final, acc, "right")
                many = right - left
                at = np.repeat(left - (np.cumsum(many) - many), many) + np.arange(many.sum())
                out.append(np.stack([np.repeat(pos, many), item[at], anchor[at]]))
        return np.concatenate(out, axis=1)


def items_sharing(acc: np.ndarray, item: np.ndarray) -> np.ndarray:
    """For each sample, of how many items windows have it."""
    if not len(acc):
        return np.zeros(0, dtype=np.int64)
    order = np.lexsort((item, acc))
    a, i = acc[order], item[order]
    new = np.concatenate([[True], a[1:] != a[:-1]])
    group = np.cumsum(new) - 1
    each = np.bincount(group, weights=np.concatenate([[True], (a[1:] != a[:-1]) | (i[1:] != i[:-1])])).astype(np.int64)
    out = np.empty(len(acc), dtype=np.int64)
    out[order] = each[group]
    return out


def best_span(item: np.ndarray, span: np.ndarray) -> tuple[int, int]:
    """Least edit distance between ``item`` and a part of ``span`` that may start
    anywhere, and the (first) end of that part."""
    n = len(span)
    place = np.arange(n + 1)
    row = np.zeros(n + 1, dtype=np.int64)
    for i, x in enumerate(item):
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (span != x))
        new[0] = i + 1
        row = np.minimum.accumulate(new - place) + place
    end = int(np.argmin(row))
    return int(row[end]), end


def windows_to_verify(walks: Walks, h: np.ndarray, first: np.ndarray, max_ratio: float):
    """(document, item, begin of the window) of the candidates, each window of an item once."""
    p, n, a = walks.candidates(h)
    doc = np.searchsorted(first, p, "right") - 1
    most = np.array([most_edits(len(x), max_ratio) for _, x in walks.items] or [0], dtype=np.int64)[n]
    # One verification looks 2 * most words to both sides, and a match may begin ``most`` words
    # from its candidate; the other ``most`` is the width of a window.
    begin = p - a
    width = most - most // 2 + 1
    order = np.lexsort((begin, begin // width, n, doc))
    key = np.stack([doc, n, begin // width])[:, order]
    new = np.ones(key.shape[1], dtype=bool)
    new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
    one = order[new]
    return zip(doc[one].tolist(), n[one].tolist(), begin[one].tolist())


def verified(walks: Walks, h: np.ndarray, first: np.ndarray, max_ratio: float):
    """Found items per document: (document, item, distance, first, last word, hits)."""
    best: dict[tuple[int, int], list] = {}
    ends: dict[tuple[int, int], int] = {}
    for doc, n, begin in windows_to_verify(walks, h, first, max_ratio):
        item = walks.items[n][1]
        most = most_edits(len(item), max_ratio)
        lo, hi = int(first[doc]), int(first[doc + 1])
        if most == 0:
            # No edit is allowed, and the window's begin is the match's.
            if begin < lo or begin + len(item) > hi or (h[begin:begin + len(item)] != item).any():
                continue
            found = best.setdefault((doc, n), [0, begin - lo, begin - lo + len(item) - 1, 0])
            if begin - lo > ends.get((doc, n), -1):
                found[3] += 1
                ends[doc, n] = begin - lo + len(item) - 1
            continue
        s = max(lo, begin - 2 * most)
        span = h[s:min(hi, begin + len(item) + 2 * most)]
        # Words that the span lacks are edits: a lower bound before the exact distance.
        if len(item) - np.isin(item, span).sum() > most:
            continue
        distance, end = best_span(item, span)
        if distance > most:
            continue
        _, back = best_span(item[::-1], span[:end][::-1])
        place = (s + end - back - lo, s + end - 1 - lo)
        old = best.get((doc, n))
        # Candidates come in order of their position, and several may meet one place.
        fresh = place[0] > ends.get((doc, n), -1)
        if fresh:
            ends[doc, n] = place[1]
        if old is None:
            best[doc, n] = [distance, *place, 1]
        else:
            best[doc, n] = [*min((distance, *place), tuple(old[:3])), old[3] + fresh]
    return [(doc, n, *v) for (doc, n), v in sorted(best.items())]


def _edited(rng: np.random.Generator, item: np.ndarray, most: int, spread: bool) -> np.ndarray:
    if spread:
        text = item.copy()
        text[np.linspace(0, len(item) - 1, most + 2)[1:-1].round().astype(int)] = U64(1)
        return text
    text = list(item)
    for _ in range(most):
        at, kind = int(rng.integers(len(text))), int(rng.integers(3))
        text[at:at + (kind != 2)] = [] if kind == 1 else [U64(rng.integers(1, 2**62))]
    return np.array(text, dtype=U64)


@functools.cache
def repetitions_for(recall: float, max_ratio: float, size: int, samples: int = 60) -> int:
    """Repetitions after which a passage of ``size`` words with ``max_ratio`` of them edited
    is found with that recall: from the share that single repetitions find."""
    rng = np.random.default_rng(5)
    most, places = most_edits(size, max_ratio), places_for(size, max_ratio)
    if not most:
        return 1
    least = 1.0
    for spread in (False, True):
        hits = 0
        for _ in range(samples):
            item = rng.integers(2, 2**62, size).astype(U64)
            walks = Walks([((0,), item)], max_ratio, {places: 4})
            text = _edited(rng, item, most, spread)
            whole, walks.tables = walks.tables, []
            for one in whole:
                walks.tables = [one]
                hits += walks.candidates(text).shape[1] > 0
        least = min(least, hits / (4 * samples))
    p = min(max(least, 0.05), 0.98)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def repetitions(sizes: set[int], max_ratio: float, recall: float) -> dict[int, int]:
    """Repetitions of each class of items, by its shortest ones (fewest windows)."""
    shortest: dict[int, int] = {}
    for n in sorted(sizes, reverse=True):
        shortest[places_for(n, max_ratio)] = n
    return {places: repetitions_for(recall, max_ratio, n) for places, n in shortest.items()}


def read_words(texts: pa.Array):
    """The words of texts, with spaces set around the characters of unspaced scripts."""
    spaced = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.string()), ""), UNSPACED, r" \1 ")
    return words(spaced, WORD_BYTES, LOWER)


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_ratio: float = MAX_RATIO, recall: float = RECALL,
                  min_words: int = MIN_WORDS, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: its best matching span
    (words from 0), edit distance, and number of disjoint places; see the module text."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.col(item_text).cast("string").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    slices = max(1, -(-size // SLICE_BYTES))
    out = None
    for k in range(slices):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == k).collect()
        found = _scan(texts, distinct_items(part, min_words), max_ratio, recall)
        out = found if out is None else out.union(found)
    return out


def distinct_items(rows: list, min_words: int) -> list[tuple]:
    """(ids, word hashes) of the items, those of equal words together."""
    w = read_words(pa.array([r["text"] for r in rows], pa.string()))
    by_words: dict[bytes, tuple] = {}
    for r, a, b in zip(rows, w.first[:-1], w.first[1:], strict=True):
        if b - a >= max(1, min_words):
            by_words.setdefault(w.h[a:b].tobytes(), ([], w.h[a:b].copy()))[0].append(r["item_id"])
    return list(by_words.values())


# The index of the slice that this worker process searched last.
_BUILT: dict[str, Walks] = {}


def _index(name: str, known: list, max_ratio: float, reps: dict[int, int]) -> Walks:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Walks(known, max_ratio, reps)
    return _BUILT[name]


def _scan(texts: DataFrame, known: list, max_ratio: float, recall: float) -> DataFrame:
    reps = repetitions({len(h) for _, h in known}, max_ratio, recall)
    sent = texts.sparkSession.sparkContext.broadcast(known)
    name = uuid.uuid4().hex

    def run(batches):
        walks = _index(name, sent.value, max_ratio, reps)
        for batch in chunks(batches):
            w = read_words(batch.column("text"))
            rows = [(r[0], i, *r[1:]) for r in verified(walks, w.h, w.first, max_ratio) for i in walks.items[r[1]][0]]
            doc = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
            col = lambda i: pa.array([r[i] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [doc, col(1), pa.array([len(walks.items[r[2]][1]) for r in rows], pa.int32()), col(3).cast(pa.int32()),
                 col(4), col(5), col(6).cast(pa.int32())], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return texts.mapInArrow(run, SCHEMA)


@query("op3_benchmark_decontamination")
def op3_benchmark_decontamination(spark, sf_dir):
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
