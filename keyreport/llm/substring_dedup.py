"""Removal of repeated word passages, found by recompression.

Each document's words are recompressed in rounds. A round names maximal runs of a
symbol, then pairs (left, right) of neighbours, where a coin per symbol and round
says left or right. Names are 64-bit hashes of what they replace, so every task
gives the same name everywhere and no dictionary is shuffled. A symbol keeps the
word interval that decides it: the words it covers and the neighbours that were
looked at to end its run or pair. If that interval lies inside a passage, every
occurrence of the passage has the same symbol there.

A window of ``width`` words is represented by one of the last round's symbols whose
interval lies inside it, the one with the smallest hash; a window without one (low
complexity, or a document's edge) stands for itself. Either way equal windows
have equal representatives. So only representatives that occur twice in the corpus
can belong to repeated windows; their windows are hashed (96 bits) and compared
by that hash, the earliest occurrence stays, and all words covered by a
later one go.

Whole copies of an earlier document are found by a hash of all their words first
and don't enter the index. Counts are combined before their shuffle and joined
back by joins that may be split (the earliest place of a window is a partial
minimum, too), and of equal windows a task sends one, so a
passage that a third of all documents share meets no single task. Python gets a row's
text and spans only; its other columns stay in the JVM.

Defined results: text null or without words: 0 words, empty kept text. Documents
with fewer than ``width`` words lose nothing. Order is (id, start); a null id comes
after all others. Rows that repeat an id count as the same document: equal
starts are not earlier than each other. With ``row_col``, a column of numbers that no
two rows share, each row is a document of its own, and rows that repeat an id are
ordered by it. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyreport.llm.common import (
    CHUNK_BYTES, NOT_SPACE, U64, Words, chunks, i64, join_small, lists, mix, range_hashes, table, tidy, words, written,
)
from keyreport.llm.queries import query

WIDTH = 20
ROUNDS = 2
FAR = np.int64(1) << 60
# Windows a task holds to find equal ones among them.
HELD_WINDOWS = 200_000


def recompress(h: np.ndarray, first: np.ndarray, rounds: int = ROUNDS):
    """Symbols of the flat words ``h`` of documents ``first[i]:first[i+1]`` after
    ``rounds``: first and last word of the interval that decides each symbol, in
    order. Symbols that a document's edge decides are left out."""
    sym = h
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    low = np.arange(len(h), dtype=np.int64)
    high = low.copy()
    with np.errstate(over="ignore"):
        for r in range(rounds):
            if not len(sym):
                break
            # Runs.
            fresh = np.concatenate([[True], (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])])
            s = np.flatnonzero(fresh)
            e = np.append(s[1:], len(sym))
            k = (e - s).astype(U64)
            before = np.concatenate([[-FAR], np.where(doc[s[1:]] == doc[s[1:] - 1], low[s[1:] - 1], -FAR)])
            after = np.concatenate([np.where(doc[e[:-1]] == doc[e[:-1] - 1], high[e[:-1]], FAR), [FAR]])
            sym = np.where(k == 1, sym[s], mix(sym[s] + k * U64(0x9E3779B97F4A7C15)))
            doc, low, high = doc[s], before, after
            # Pairs.
            right = (mix(sym + U64(r + 1) * U64(0xD1342543DE82EF95)) >> U64(63)).astype(bool)
            same = doc[1:] == doc[:-1]
            pair = np.append(~right[:-1] & right[1:] & same, False)
            second = np.concatenate([[False], pair[:-1]])
            alone = ~pair & ~second
            before = np.concatenate([[-FAR], np.where(same, low[:-1], -FAR)])
            after = np.append(np.where(same, high[1:], FAR), FAR)
            low = np.where(alone & right, before, low)
            high = np.where(pair, np.append(high[1:], FAR), np.where(alone & ~right, after, high))
            sym = np.where(pair, mix(sym * U64(0x2545F4914F6CDD1D) + np.append(sym[1:], U64(0))), sym)
            sym, doc, low, high = sym[~second], doc[~second], low[~second], high[~second]
    inside = (low > -FAR) & (high < FAR)
    return low[inside], high[inside]


def representatives(w: Words, width: int, rounds: int = ROUNDS):
    """For each window of the chunk: its first word and the hash that represents it,
    and a number of the representative that neighbouring windows share."""
    h, first = w.h, w.first
    count = np.maximum(np.diff(first) - width + 1, 0)
    start = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    low, high = recompress(h, first, rounds)
    fits = high - low < width
    low, high = low[fits], high[fits]
    key = range_hashes(h, low, high + 1, 2)
    a = np.searchsorted(low, start)
    b = np.searchsorted(high, start + width - 1, "right")
    own = b <= a
    rep = np.empty(len(start), dtype=U64)
    unit = np.empty(len(start), dtype=np.int64)
    rep[own] = mix(range_hashes(h, start[own], start[own] + width, 2))
    unit[own] = len(key) + np.flatnonzero(own)
    if len(key):
        some = np.flatnonzero(~own)
        # Smallest hash in [a, b), leftmost first: best[j] covers 2^j symbols.
        a, size = a[some], (b - a)[some]
        best = [np.arange(len(key))]
        while (1 << len(best)) <= size.max(initial=0):
            x, step = best[-1], 1 << (len(best) - 1)
            y = np.append(x[step:], np.repeat(x[-1:], step))[:len(x)]
            best.append(np.where(key[y] < key[x], y, x))
        level = np.frexp(size.astype(np.float64))[1] - 1
        both = np.stack(best)
        x, y = both[level, a], both[level, a + size - (1 << level)]
        pick = np.where(key[y] < key[x], y, x)
        rep[some], unit[some] = key[pick], pick
    return start, rep, unit


def _named(docs: DataFrame, id_col: str, text_col: str, row_col: str | None) -> DataFrame:
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1))
    text = F.col(text_col).cast("string")
    # t tells texts apart if rows repeat an id.
    t = F.xxhash64(text) if row_col is None else F.col(row_col).cast("long")
    return docs.select(doc.alias("doc"), t.alias("t"), text.alias("text"), F.struct("*").alias("record"))


def index(docs: DataFrame, width: int) -> DataFrame:
    """Per row: word count, 128-bit hash of all words, representatives' hashes."""
    def run(batches):
        for batch in chunks(batches):
            w = words(batch.column("text"), NOT_SPACE)
            start, rep, unit = representatives(w, width)
            new = np.concatenate([[True], unit[1:] != unit[:-1]]) if len(unit) else np.zeros(0, dtype=bool)
            start, rep = start[new], rep[new]
            cut = np.searchsorted(start, w.first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("t"), i64(np.diff(w.first)),
                 i64(range_hashes(w.h, w.first[:-1], w.first[1:], 3)), i64(range_hashes(w.h, w.first[:-1], w.first[1:], 4)),
                 lists([rep[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)])],
                names=["doc", "t", "n", "f1", "f2", "keys"])

    return docs.select("doc", "t", "text").mapInArrow(run, "doc long, t long, n long, f1 long, f2 long, keys array<long>")


def windows(docs: DataFrame, width: int, by_row: bool = False) -> DataFrame:
    """The windows of ``docs(doc, t, text, keys)`` whose representative is in ``keys``:
    96 bits of hash, first word, and count 1. Of equal windows met in one batch of a
    task only the earliest is given so; the others, which can't be the earliest of
    all, are given as runs (first word, count > 0, known later) under hashes of
    their own, so a passage that a third of all documents share sends a row per batch."""
    schema = "doc long, t long, pos int, n int, later boolean, w1 long, w2 int"

    def earliest(parts):
        doc, t, pos, w1, w2 = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((pos, t, doc, w2, w1) if by_row else (pos, doc, w2, w1))
        a, b = w1[order], w2[order]
        first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        place = (doc[order], pos[order])
        head = np.flatnonzero(first)[np.cumsum(first) - 1]
        # A repeated id may repeat the place, too: then neither is later.
        late = (place[0] != place[0][head]) | (place[1] != place[1][head])
        if by_row:
            late |= t[order] != t[order][head]
        one = order[~late]
        yield doc[one], t[one], pos[one], np.ones(len(one), np.int32), np.zeros(len(one), bool), w1[one], w2[one]
        rest = order[late]
        rest = rest[np.lexsort((pos[rest], t[rest], doc[rest]))]
        if len(rest):
            d, u, q = doc[rest], t[rest], pos[rest]
            cut = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (u[1:] != u[:-1]) | (q[1:] != q[:-1] + 1)]))
            n = np.diff(np.append(cut, len(rest))).astype(np.int32)
            d, u, q = d[cut], u[cut], q[cut]
            with np.errstate(over="ignore"):
                own = mix(d.view(U64) * U64(0x9E3779B97F4A7C15) + u.view(U64) + q.astype(U64))
            yield d, u, q, n, np.ones(len(cut), bool), own.view(np.int64), np.full(len(cut), -1, np.int32)

    def given(parts):
        for d, t, pos, n, later, w1, w2 in earliest(parts):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (d, t, pos, n, later, w1, w2)],
                                             names=["doc", "t", "pos", "n", "later", "w1", "w2"])

    def run(batches):
        held, size = [], 0
        for batch in chunks(batches, limit=CHUNK_BYTES // 2):
            w = words(batch.column("text"), NOT_SPACE, lanes=2)
            start, rep, _ = representatives(w, width)
            keys = batch.column("keys")
            flat, off = keys.flatten().to_numpy(), np.concatenate([[0], np.cumsum(keys.value_lengths().to_numpy())])
            cut = np.searchsorted(start, w.first)
            hit = np.zeros(len(start), dtype=bool)
            for i in range(batch.num_rows):
                hit[cut[i]:cut[i + 1]] = np.isin(rep[cut[i]:cut[i + 1]], flat[off[i]:off[i + 1]].view(U64))
            start = start[hit]
            doc = np.searchsorted(w.first, start, "right") - 1
            w1, w2 = (range_hashes(x, start, start + width, 5 + k).view(np.int64) for k, x in enumerate(w.lanes))
            held.append((np.asarray(batch.column("doc"))[doc], np.asarray(batch.column("t"))[doc],
                         (start - w.first[doc]).astype(np.int32), w1, (w2 >> 33).astype(np.int32)))
            size += len(start)
            if size >= HELD_WINDOWS:
                yield from given(held)
                held, size = [], 0
        if size:
            yield from given(held)

    return docs.select("doc", "t", "text", "keys").mapInArrow(run, schema)


def as_spans(runs: DataFrame) -> DataFrame:
    """``runs(doc, t, runs)`` of windows as disjoint spans: first words and counts."""
    def run(batches):
        for batch in batches:
            first, count = [], []
            for i in range(batch.num_rows):
                x = batch.column("runs")[i].values
                pos, n = np.asarray(x.field("pos")).astype(np.int64), np.asarray(x.field("n")).astype(np.int64)
                order = np.argsort(pos, kind="stable")
                pos, end = pos[order], np.maximum.accumulate((pos + n)[order])
                new = np.concatenate([[True], pos[1:] > end[:-1]]) if len(pos) else np.zeros(0, bool)
                first.append(pos[new])
                count.append(np.append(end[:-1][new[1:]], end[-1:]) - pos[new])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("t"), lists(first), lists(count)],
                                             names=["doc", "t", "starts", "counts"])

    return runs.mapInArrow(run, "doc long, t long, starts array<long>, counts array<long>")


def kept_texts(docs: DataFrame, width: int, joined: bool, text_col: str) -> DataFrame:
    """The texts of ``docs(record, starts, counts, copy)`` without the words that
    the spans of windows at ``starts`` cover (``copy``: without any). ``joined``: words joined by
    one space; otherwise a text that loses nothing stays as it is, and others keep
    the white space behind the words that stay."""
    def kept(batch: pa.RecordBatch) -> pa.StructArray:
        w = words(batch.column("text"), NOT_SPACE)
        n = np.diff(w.first)
        gone = np.zeros(len(w.start) + 1, dtype=np.int64)
        starts = batch.column("starts")
        sizes = np.asarray(starts.value_lengths().fill_null(0))
        at = starts.flatten().to_numpy() + np.repeat(w.first[:-1], sizes)
        np.add.at(gone, at, 1)
        np.add.at(gone, at + batch.column("counts").flatten().to_numpy() + width - 1, -1)
        gone = np.cumsum(gone[:-1]) > 0
        gone |= np.repeat(np.asarray(batch.column("copy").fill_null(False)) & (n >= width), n)
        lost = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first])
        # A byte stays if its word stays, with the byte behind the word.
        delta = np.zeros(len(w.data) + 2, dtype=np.int8)
        keep = ~gone
        s, e = w.start[keep], w.end[keep]
        delta[s] += 1
        delta[e + 1] -= 1
        stay = np.cumsum(delta[:-2], dtype=np.int8) > 0
        out = w.data.copy()
        if joined:
            out[e] = 0x20
        size = np.concatenate([[0], np.cumsum(stay)])
        edge = np.append(w.start, len(w.data))[w.first]
        raw, cut = out[stay].tobytes(), size[edge]
        texts = [raw[a:b - 1].decode("utf-8") if b > a else "" for a, b in zip(cut[:-1], cut[1:], strict=True)]
        if not joined:
            texts = [t if x else o.as_py() for t, x, o in zip(texts, lost, batch.column("text"), strict=True)]
        return pa.StructArray.from_arrays([i64(n), i64(lost), pa.array(texts, pa.string())], names=names)

    names = ["n_words", "n_removed", "kept_text"]

    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, kept_text: string>")
    def judge(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        # A piece of a batch at a time: neither side holds a whole batch of new texts.
        rows = (pa.RecordBatch.from_arrays(list(x), names=["text", "starts", "counts", "copy"]) for x in batches)
        for part in chunks(rows):
            yield kept(part)

    # A filter on its result is not to compute it again below itself.
    judge = judge.asNondeterministic()
    text = F.col("record").getField(text_col).cast("string")
    found = docs.select("record", judge(text, "starts", "counts", "copy").alias("found"))
    return found.select("record", *(f"found.{x}" for x in names))


@tidy
def _shared(docs: DataFrame, width: int, by_row: bool) -> tuple[DataFrame, DataFrame]:
    """The later of equal texts, and for each other text the representatives' hashes that
    stand twice. The index of all texts goes here."""
    rows = written(index(docs, width), "substring-index")
    long = rows.where(F.col("n") >= width)
    place = F.struct("doc", "t") if by_row else F.col("doc")
    equal = long.groupBy("f1", "f2").agg(F.min(place).alias("x"), F.max(place).alias("y")).where("x <> y")
    copies = written(long.select("doc", "t", "f1", "f2").join(equal, ["f1", "f2"]).where(place != F.col("x"))
                     .select("doc", "t").distinct(), "substring-copies")
    texts = join_small(long, copies, ["doc", "t"], "left_anti")
    each = texts.select("doc", "t", F.explode("keys").alias("key"))
    twice = written(each.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "substring-keys")
    # Hashes grow with the corpus: they are shuffled at every size.
    mine = each.join(twice.hint("merge"), "key", "left_semi").groupBy("doc", "t").agg(F.collect_set("key").alias("keys"))
    mine = written(mine, "substring-shared")
    return copies, mine


@tidy
def substring_dedup(docs: DataFrame, width: int = WIDTH, joined: bool = True,
                    id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(record, n_words, n_removed, kept_text) per row of ``docs``: record is a struct
    of its columns; see the module text."""
    by_row = row_col is not None
    docs = _named(docs, id_col, text_col, row_col)
    copies, mine = _shared(docs, width, by_row)
    found = windows(join_small(docs.drop("record"), mine, ["doc", "t"], "inner", F.size("keys") * 8 + 64), width, by_row)
    found = written(found, "substring-windows")
    place = F.struct("doc", "t", "pos") if by_row else F.struct("doc", "pos")
    heads = found.where(~F.col("later"))
    # Only windows that start at two places need their earliest one.
    first = heads.groupBy("w1", "w2").agg(F.min(place).alias("m"), F.max(place).alias("x")).where("m <> x")
    first = written(first.drop("x"), "substring-firsts")
    later = heads.join(first.hint("merge"), ["w1", "w2"]).where(place != F.col("m"))
    runs = later.select("doc", "t", "pos", "n").unionByName(found.where("later").select("doc", "t", "pos", "n"))
    runs = runs.groupBy("doc", "t").agg(F.collect_list(F.struct("pos", "n")).alias("runs"))
    none = F.array().cast("array<long>")
    marks = as_spans(runs).withColumn("copy", F.lit(False)).unionByName(
        copies.select("doc", "t", none.alias("starts"), none.alias("counts"), F.lit(True).alias("copy")))
    marks = written(marks, "substring-marks")
    # The record holds the text: if the rows are shuffled, it goes once.
    whole = join_small(docs.drop("text"), marks, ["doc", "t"], "left", F.size("starts") * 16 + 64)
    return kept_texts(whole, width, joined, text_col)


@query("op6_substring_dedup")
def op6_substring_dedup(spark, sf_dir):
    kept = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), width=WIDTH)
    return kept.select("record.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
