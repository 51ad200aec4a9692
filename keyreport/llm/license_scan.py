"""Licence scan by a generalised suffix automaton over licence words.

The automaton holds every run of words of every template. A text's words are
streamed through it: after each word its state and length are the longest run,
ending there, that occurs in some template (matching statistics). Runs of at
least ``MIN_RUN`` words that can't be extended are matches; a state knows
where in which templates its runs end. Matches of one template that
follow each other in text and template, at most ``MAX_GAP`` words apart in the text, are
chained; a chain that covers at least ``MIN_COVER`` of the template's words is a span
of that licence. The score is the highest cover of any span (0 without one, at most 1).

Streaming starts only where at least ``MIN_RUN`` words in a row follow each other in
templates two by two, found for the whole chunk at once; no longer match can begin
elsewhere, so nothing is missed. Base phrases are counted at every place where
their words stand consecutively.

The automaton is built from fixed texts, so its size doesn't depend on the corpus.
One pass, no shuffle. Defined results: text null or empty: no words, labels
empty, score 0. Rows that repeat an id are scanned each. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyreport.llm.common import LOWER, WORD_BYTES, Words, chunks, i64, table, words
from keyreport.llm.license_texts import PHRASES, TEMPLATES
from keyreport.llm.queries import query

MIN_RUN = 4
MAX_GAP = 30
MIN_COVER = 0.8

SPANS = "array<struct<label: string, template: int, first_word: long, last_word: long, cover: double>>"
SCHEMA = ("doc_id long, n_words long, base_places array<struct<label: string, word: long>>, "
          f"spans {SPANS}, score double")


@dataclass
class State:
    length: int
    link: int
    step: dict[int, int] = field(default_factory=dict)
    ends: set[tuple[int, int]] = field(default_factory=set)  # (template, position of the last word)


class Automaton:
    """Suffix automaton of several sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.states = [State(0, -1)]
        for t, sequence in enumerate(sequences):
            last = 0
            for pos, x in enumerate(sequence):
                last = self._extend(last, x)
                self.states[last].ends.add((t, pos))
        # What ends in a longer run's places ends in its suffixes' places.
        for s in sorted(self.states[1:], key=lambda s: -s.length):
            if s.link > 0:
                self.states[s.link].ends |= s.ends

    def _extend(self, last: int, x: int) -> int:
        st = self.states
        if x in st[last].step:
            q = st[last].step[x]
            return q if st[q].length == st[last].length + 1 else self._clone(last, x, q)
        new = len(st)
        st.append(State(st[last].length + 1, 0))
        p = last
        while p >= 0 and x not in st[p].step:
            st[p].step[x] = new
            p = st[p].link
        if p >= 0:
            q = st[p].step[x]
            st[new].link = q if st[q].length == st[p].length + 1 else self._clone(p, x, q)
        return new

    def _clone(self, p: int, x: int, q: int) -> int:
        st = self.states
        c = len(st)
        st.append(State(st[p].length + 1, st[q].link, dict(st[q].step)))
        st[q].link = c
        while p >= 0 and st[p].step.get(x) == q:
            st[p].step[x] = c
            p = st[p].link
        return c

    def matches(self, sequence: list[int], least: int):
        """(end in sequence, length, state) of the runs that can't be extended."""
        st, state, length = self.states, 0, 0
        for i, x in enumerate(sequence):
            before, had = state, length
            while state and x not in st[state].step:
                state = st[state].link
                length = st[state].length
            if x in st[state].step:
                state, length = st[state].step[x], length + 1
            if length <= had and had >= least:
                yield i - 1, had, before
        if length >= least:
            yield len(sequence) - 1, length, state


class Scanner:
    """Word numbers, word pairs and automaton of templates and phrases."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        texts = [t for _, t in templates] + [p for _, p in phrases]
        w = words(pa.array(texts), WORD_BYTES, LOWER)
        self.known, ids = np.unique(w.h, return_inverse=True)
        split = [ids[a:b].tolist() for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        self.labels = [x for x, _ in templates]
        self.templates = split[:len(templates)]
        self.phrases = [(x, s) for (x, _), s in zip(phrases, split[len(templates):], strict=True)]
        self.automaton = Automaton(self.templates)
        n = len(self.known)
        self.follows = np.zeros((n + 1, n + 1), dtype=bool)
        for s in self.templates:
            for a, b in zip(s[:-1], s[1:], strict=True):
                self.follows[a, b] = True
        self.first_bits = np.zeros(1 << 16, dtype=bool)
        self.first_bits[(self.known >> np.uint64(48)).astype(np.int64)] = True

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Each word's number, the number of words for an unknown one."""
        n = len(self.known)
        out = np.full(len(h), n, dtype=np.int64)
        some = np.flatnonzero(self.first_bits[(h >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, h[some]), n - 1)
        same = self.known[at] == h[some]
        out[some[same]] = at[same]
        return out

    def scan(self, w: Words):
        """Per text: base places (label, word) and spans (label, template, first, last, cover)."""
        texts = len(w.first) - 1
        ids = np.append(self.numbers(w.h), len(self.known))
        owner = np.repeat(np.arange(texts), np.diff(w.first))
        base: list[list] = [[] for _ in range(texts)]
        for label, phrase in self.phrases:
            at = np.flatnonzero(ids[:-1] == phrase[0])
            at = at[at + len(phrase) <= len(owner)]
            for j, x in enumerate(phrase[1:], 1):
                at = at[ids[at + j] == x]
            at = at[owner[at] == owner[at + len(phrase) - 1]]
            for p, d in zip(at.tolist(), owner[at].tolist(), strict=True):
                base[d].append((label, p - int(w.first[d])))
        found: list[list] = [[] for _ in range(texts)]
        if len(owner) > 1:
            good = self.follows[ids[:-2], ids[1:-1]] & (owner[:-1] == owner[1:])
            edge = np.flatnonzero(np.diff(np.concatenate([[0], good.astype(np.int8), [0]])))
            begin, end = edge[0::2], edge[1::2] + 1  # words begin .. end - 1
            keep = end - begin >= MIN_RUN
            for a, b in zip(begin[keep].tolist(), end[keep].tolist(), strict=True):
                d = int(owner[a])
                for i, n, state in self.automaton.matches(ids[a:b].tolist(), MIN_RUN):
                    found[d].append((a + i - n + 1 - int(w.first[d]), n, state))
        return base, [self.spans(m) for m in found]

    def spans(self, matches: list[tuple[int, int, int]]) -> list[tuple]:
        """Chains over ``matches`` (first word in the text, length, state), by template."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for start, n, state in matches:
            for t, end in self.automaton.states[state].ends:
                by_template.setdefault(t, []).append((start, end - n + 1, n))
        out = []
        for t, ms in sorted(by_template.items()):
            ms.sort()
            # Best chain ending in each match: (words covered, its first word).
            best: list[tuple[int, int]] = []
            low = 0
            for i, (x, y, n) in enumerate(ms):
                while low < i and ms[low][0] + len(self.templates[t]) + MAX_GAP < x:
                    low += 1
                covered, first = n, x
                for j in range(low, i):
                    px, py, pn = ms[j]
                    if px < x and py < y and x - (px + pn) <= MAX_GAP:
                        more = best[j][0] + n - max(0, px + pn - x, py + pn - y)
                        if more > covered:
                            covered, first = more, best[j][1]
                best.append((covered, first))
            size = len(self.templates[t])
            last = -1
            for (c, first), (x, _, n) in sorted(zip(best, ms, strict=True), key=lambda z: (z[0][1], -z[0][0])):
                if first > last and c / size >= MIN_COVER:
                    out.append((self.labels[t], t, first, x + n - 1, min(1.0, c / size)))
                    last = x + n - 1
        return out


_SCANNER: list[Scanner] = []


def scanner() -> Scanner:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    return _SCANNER[0]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, base_places, spans, score; see the module text."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        s = scanner()
        for batch in chunks(batches):
            w = words(batch.column("text"), WORD_BYTES, LOWER)
            base, spans = s.scan(w)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), i64(np.diff(w.first)),
                 pa.array([[{"label": x, "word": p} for x, p in sorted(b, key=lambda z: (z[1], z[0]))] for b in base],
                          pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
                 pa.array([[dict(zip(("label", "template", "first_word", "last_word", "cover"), x, strict=True))
                            for x in p] for p in spans],
                          pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()),
                                              ("first_word", pa.int64()), ("last_word", pa.int64()),
                                              ("cover", pa.float64())]))),
                 pa.array([max((x[4] for x in p), default=0.0) for p in spans], pa.float64())],
                names=["doc_id", "n_words", "base_places", "spans", "score"])

    return docs.mapInArrow(run, SCHEMA)


@query("op5_license_scan")
def op5_license_scan(spark, sf_dir):
    found = license_scan(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct("base_places.label"))
    both = F.array_sort(F.array_distinct(F.concat("base_places.label", "spans.label")))
    return found.select(
        "doc_id", "n_words", F.size("base_places").cast("long").alias("n_base"),
        F.array_min("base_places.word").alias("first_word"), F.array_max("base_places.word").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"), "score",
        F.col("spans"))
