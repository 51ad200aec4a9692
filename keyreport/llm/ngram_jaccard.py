"""N-gram Jaccard join by universe-partition pigeonhole.

A document's set holds 64-bit hashes of its distinct word n-grams. Two sets of
sizes r and s with Jaccard similarity >= num/den differ in at most
``H = (den-num)(r+s)/(den+num)`` elements.

* **Segments by size band.** Sizes fall into bands; a band of largest size U cuts
  the universe of hashes into m(U) segments. A set is indexed in its own band and,
  if a partner may be larger than U, in the next one.
* **Allocation.** In a large band each segment counts 0: of two similar sets with
  more than H non-empty segments each, one of the first H+1 non-empty segments must
  hold equal subsets, and a set is indexed by the hashes of these H+1 subsets. (A
  set with too few non-empty segments, chance below 1e-6, is found through single
  elements.) In a small band (U <= 64) few segments hold many elements each and
  count 1: of (H+1)/2 segments one must differ by at most one element, and a set is
  indexed by each segment's subset and its one-deletion neighbourhood.
* **By cost.** Each index key's documents are compared with a pivot and joined into
  components. Keys that still hold several components are costly (a passage that many
  documents share). Their documents are allocated anew: every element is a
  segment, the costly (frequent) ones are skipped (allocation -1) and the H+1 rarest
  are indexed (allocation 0), in an order of (frequency, hash) common to all, so
  that similar sets still meet; frequencies are counted in a table of fixed
  size, which any common order allows. There pairs go on, pivot after pivot, until a
  key holds one component; two sets whose first common element stands at places i
  and j of that order differ in i + j elements at least, which ends most of them.
* **Verification.** Pairs of unlike sizes are left out, then pairs whose parity
  sketches (one bit per element's hash, as many bits as elements) differ in more
  than H bits, a lower bound of the sets' difference; the rest is decided exactly by
  the intersection of the two whole sets.

Each round emits one row per member of a key and pivot, never all pairs of a group.
Equal sets are grouped before the index, so copies cost one row each.

Defined results: text null, empty or without words: n_shingles 0, linked with
nothing. Null id: component null. Rows that repeat an id are one node: it has the
links of each of its texts. Equal texts under several ids share a component.
Other columns are ignored, whatever their names. "Equal" is equality of 64-bit
n-gram hashes within a compared pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyreport.llm.common import (
    LOWER, NOT_SPACE, U64, chunks, components, drop, i64, join_small, lists, mix, table, tidy, words, written,
)
from keyreport.llm.queries import query

ONE_DELETION_BAND = 64
# Counters of the table of element frequencies, whatever the corpus.
COUNTERS = 1 << 18
# Words of the sketches that blocks of members are compared by; members of a key in a
# block; rows that one task compares with their pivots; pairs it holds at once.
SHORT_WORDS = 16
BLOCK = 512
BLOCK_ROWS = 20_000
HELD_PAIRS = 1 << 16
# Pivots of a costly key in its first round and in its second; later ones have four times
# as many each. A round takes dozens of shuffles, pairs of short sketches cost little.
FIRST_PIVOTS = 32
MANY_PIVOTS = 1024


def bands(num: int, den: int) -> np.ndarray:
    """Largest size of each band; a partner lies in the same or the next band."""
    out = [1]
    while out[-1] < 2**40:
        out.append(max(out[-1] + 1, out[-1] * den * 50 // (num * 41)))
    return np.array(out)


def most_differing(size: int, partner: int, num: int, den: int) -> int:
    return (den - num) * (size + partner) // (den + num)


def shingle_sets(w, n: int):
    """For each text of ``w``: its sorted distinct n-gram hashes; with fewer than n
    words the whole sequence counts as one; without words none."""
    h = w.h
    with np.errstate(over="ignore"):
        fold = np.zeros(max(0, len(h) - n + 1), dtype=U64)
        for j in range(n):
            fold = fold * U64(0x9E3779B97F4A7C15) + h[j:len(h) - n + 1 + j]
        fold = mix(fold)
        for a, b in zip(w.first[:-1], w.first[1:], strict=True):
            if b - a >= n:
                yield np.unique(fold[a:b - n + 1])
            elif b > a:
                x = U64(b - a)
                for v in h[a:b]:
                    x = x * U64(0x9E3779B97F4A7C15) + v
                yield mix(np.array([x ^ U64(0x5851F42D4C957F2D)], dtype=U64))
            else:
                yield np.zeros(0, dtype=U64)


def band_keys(u: np.ndarray, band: int, top: int, need: int, num: int, den: int, single: bool):
    """Index keys of the sorted set ``u`` in one band, and whether they suffice.
    ``single``: by its first ``need`` elements instead of segments."""
    with np.errstate(over="ignore"):
        salt = U64(band + 1) * U64(0xD6E8FEB86659FD93)
        if single:
            return mix(u[:need] + (salt ^ U64(0xA5A5A5A5))), True
        most = most_differing(top, top, num, den)
        small = top <= ONE_DELETION_BAND
        m = (most + 2) // 2 if small else most * 5 // 4 + 4
        seg = ((u >> U64(32)) * U64(m)) >> U64(32)
        element = mix(u ^ U64(0x2545F4914F6CDD1D))
        name = salt + np.arange(m, dtype=U64) * U64(0x9E3779B97F4A7C15)
        if small:
            total = np.zeros(m, dtype=U64)
            np.add.at(total, seg.astype(np.int64), element)
            subsets = mix(total + name)
            return subsets if not most else np.concatenate(
                [subsets, mix(total[seg.astype(np.int64)] - element + name[seg.astype(np.int64)])]), True
        start = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        if len(start) > need:
            element, start = element[:start[need]], start[:need]
        return mix(np.add.reduceat(element, start) + name[seg[start].astype(np.int64)]), len(start) >= need


SIG = "doc long, n int, fp1 long, fp2 long, need int, lacking boolean, keys array<long>"


def signatures(docs: DataFrame, n: int, num: int, den: int, single: bool = False) -> DataFrame:
    """One row per row of ``docs(doc, text)``: set size, set fingerprint, index keys."""
    tops = bands(num, den)

    def run(batches):
        for batch in chunks(batches):
            w = words(batch.column("text"), NOT_SPACE, LOWER)
            ids = batch.column("doc").to_pylist()
            out = {k: [] for k in ("n", "fp1", "fp2", "need", "lacking", "keys")}
            for doc, u in zip(ids, shingle_sets(w, n), strict=True):
                size, keys, lacking, needs = len(u), [], False, 0
                if size and doc is not None:
                    k = int(np.searchsorted(tops, size))
                    partner = size * den // num
                    for band, cap in [(k, min(partner, int(tops[k])))] + [(k + 1, partner)] * int(partner > tops[k]):
                        need = most_differing(size, cap, num, den) + 1
                        found, enough = band_keys(u, band, int(tops[band]), need, num, den, single)
                        keys.append(found)
                        lacking |= not enough
                        needs = max(needs, need)
                with np.errstate(over="ignore"):
                    m = mix(u)
                    out["fp1"].append(int(m.sum(dtype=U64).view(np.int64)))
                    out["fp2"].append(int((mix(m + U64(size)).sum(dtype=U64)).view(np.int64)))
                out["n"].append(size)
                out["need"].append(needs)
                out["lacking"].append(lacking)
                out["keys"].append(np.concatenate(keys).view(np.int64) if keys else np.zeros(0, dtype=np.int64))

            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").cast(pa.int64()), pa.array(out["n"], pa.int32()), pa.array(out["fp1"], pa.int64()),
                 pa.array(out["fp2"], pa.int64()), pa.array(out["need"], pa.int32()),
                 pa.array(out["lacking"], pa.bool_()), lists(out["keys"])],
                names=["doc", "n", "fp1", "fp2", "need", "lacking", "keys"])

    return docs.select("doc", "text").mapInArrow(run, SIG)


def parity_sketch(u: np.ndarray) -> np.ndarray:
    """Parity of the number of elements per bit; at least as many bits as elements,
    a power of two. The first half xor the second is the sketch of half the size."""
    bits = max(64, 1 << max(0, len(u) - 1).bit_length())
    odd = np.bincount((u & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(U64)


def whole_sets(docs: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in chunks(batches):
            sets = list(shingle_sets(words(batch.column("text"), NOT_SPACE, LOWER), n))
            sketches = [parity_sketch(u) for u in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").cast(pa.int64()), lists(sets), lists(sketches), lists([shortened(x) for x in sketches])],
                names=["doc", "s", "sketch", "short"])

    return docs.select("doc", "text").mapInArrow(
        run, "doc long, s array<long>, sketch array<long>, short array<long>")


def shortened(sketch: np.ndarray) -> np.ndarray:
    while len(sketch) > SHORT_WORDS:
        sketch = sketch[:len(sketch) // 2] ^ sketch[len(sketch) // 2:]
    return sketch


def near_pairs(members: pa.Table, pivots: pa.Table, num: int, den: int) -> pa.Table:
    """Pairs (member, pivot) of one key that may be linked by size, place and short
    sketch. Pairs are formed in numpy, a bounded number at once; only these leave."""
    found = []
    if members.num_rows and pivots.num_rows:
        m = {c: np.asarray(members[c]) for c in ("key", "blk", "doc", "n", "place", "c")}
        p = {c: np.asarray(pivots[c]) for c in ("key", "blk", "doc", "n", "place", "c")}
        sketch = []
        for side in (members, pivots):
            column = side["short"].combine_chunks()
            flat, size = np.asarray(column.flatten()).view(U64), np.asarray(column.value_lengths())
            # Every sketch at each length up to its own: column k holds 2^k words.
            at = np.cumsum(size) - size
            sketch.append([flat[at[:, None] + np.minimum(np.arange(1 << k), size[:, None] - 1)]
                           for k in range(SHORT_WORDS.bit_length())] + [size])
            for k in range(SHORT_WORDS.bit_length() - 2, -1, -1):
                longer = np.flatnonzero(size > 1 << k)
                x = sketch[-1][k + 1][longer]
                sketch[-1][k][longer] = x[:, :1 << k] ^ x[:, 1 << k:]
        with np.errstate(over="ignore"):
            name = [mix(x["key"].view(U64) + x["blk"].astype(U64) * U64(0x9E3779B97F4A7C15)) for x in (m, p)]
        order = np.argsort(name[1], kind="stable")
        lo, hi = (np.searchsorted(name[1][order], name[0], side) for side in ("left", "right"))
        until = np.cumsum(hi - lo)
        cuts = np.unique(np.concatenate([[0], np.searchsorted(until, np.arange(HELD_PAIRS, until[-1], HELD_PAIRS)),
                                         [len(lo)]]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            count = hi[a:b] - lo[a:b]
            i = np.repeat(np.arange(a, b), count)
            j = order[np.repeat(lo[a:b] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
            n, k = m["n"][i], p["n"][j]
            most = (n + k) * (den - num)
            ok = ((m["doc"][i] != p["doc"][j]) & (m["c"][i] != p["c"][j]) & (m["key"][i] == p["key"][j])
                  & (np.minimum(n, k) * den >= np.maximum(n, k) * num)
                  & ((m["place"][i] + p["place"][j]) * (den + num) <= most))
            i, j, most = i[ok], j[ok], most[ok]
            size = np.minimum(sketch[0][-1][i], sketch[1][-1][j])
            keep = np.zeros(len(i), dtype=bool)
            for w in range(SHORT_WORDS.bit_length()):
                at = np.flatnonzero(size == 1 << w)
                bits = np.bitwise_count(sketch[0][w][i[at]] ^ sketch[1][w][j[at]]).sum(axis=1, dtype=np.int64)
                keep[at] = bits * (den + num) <= most[at]
            found.append(np.stack([m["doc"][i[keep]], p["doc"][j[keep]]]))
    a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
    return pa.table({"a": i64(np.minimum(a, b)), "b": i64(np.maximum(a, b))})


class _Links:
    """Compares the members of index keys and keeps the links found."""

    def __init__(self, docs: DataFrame, ids: DataFrame, n: int, num: int, den: int):
        self.num, self.den, self.roots = num, den, None
        self.sets = written(whole_sets(join_small(docs, ids, "doc", "left_semi"), n), "jaccard-sets")
        self.sketches = written(self.sets.select("doc", F.size("s").cast("long").alias("n"), "sketch", "short"),
                                "jaccard-sketches")

    def may_link(self, na: Column, nb: Column, places: Column) -> Column:
        """Whether sets of these sizes can be linked, whose first common element
        has ``places`` elements of either before it."""
        return ((F.least(na, nb) * self.den >= F.greatest(na, nb) * self.num)
                & (places * (self.den + self.num) <= (na + nb) * (self.den - self.num)))

    @tidy
    def linked(self, pairs: DataFrame) -> DataFrame:
        """The linked ones of ``pairs(a, b)``."""
        def half(s: Column) -> Column:
            n = (F.size(s) / 2).cast("int")
            return F.zip_with(F.slice(s, 1, n), F.slice(s, n + 1, n), lambda x, y: x.bitwiseXOR(y))

        def fold(s: Column, other: Column) -> Column:
            return F.when(F.size(s) > F.size(other), half(s)).otherwise(s)

        x, y = F.col("sketch_a"), F.col("sketch_b")
        apart = F.aggregate(F.zip_with(fold(x, y), fold(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                            F.lit(0), lambda t, v: t + v)
        na, nb = F.col("n_a"), F.col("n_b")
        right = self.sketches.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
        left = self.sketches.select(F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
        # Sketches and sets grow with the corpus: they are shuffled at every size.
        near = pairs.join(right.hint("merge"), "b")
        near = (near.join(left.hint("merge"), "a")
                .where(self.may_link(na, nb, F.lit(0)))
                .where(apart * (self.den + self.num) <= (na + nb) * (self.den - self.num)).select("a", "b").distinct())
        near = written(near, "jaccard-near")
        if not near.isEmpty():
            ids = written(near.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "jaccard-near-ids")
            sets = written(join_small(self.sets.select("doc", "s"), ids, "doc", "left_semi"), "jaccard-near-sets")
            left, right = (sets.select(F.col("doc").alias(z), F.col("s").alias(f"s_{z}")) for z in "ab")
            both = F.size(F.array_intersect("s_a", "s_b")).cast("long")
            near = near.join(right.hint("merge"), "b")
            near = (near.join(left.hint("merge"), "a")
                    .select("a", "b", both.alias("i"), (F.size("s_a") + F.size("s_b")).alias("t"))
                    .where(F.col("i") * self.den >= (F.col("t") - F.col("i")) * self.num).select("a", "b"))
            near = written(near, "jaccard-links")
        return near

    def compare(self, pairs: DataFrame) -> None:
        """Verify ``pairs(a, b)`` and join the linked ones."""
        near = self.linked(pairs)
        if self.roots is not None and near.isEmpty():
            return
        known = near if self.roots is None else near.union(
            self.roots.select(F.col("id").alias("a"), F.col("root").alias("b")))
        self.roots = written(components(known, "jaccard-cc"), "jaccard-roots")

    def mixed(self, bucket: DataFrame) -> DataFrame:
        """The rows of ``bucket(key, doc, n, place)`` with their components ``c``, of the keys
        that still hold several."""
        roots = self.roots.select(F.col("id").alias("doc"), "root")
        named = join_small(bucket, roots, "doc", "left").withColumn("c", F.coalesce("root", "doc")).drop("root")
        mixed = named.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.min("place").alias("least"))
        mixed = written(mixed.where("x <> y").select("key", "least"), "jaccard-mixed-keys")
        # The largest difference from any partner bounds the places that can still matter.
        reach = F.col("n") + F.floor(F.col("n") * self.den / self.num)
        return written(join_small(named, mixed, "key").where(
            (F.col("place") + F.col("least")) * (self.den + self.num) <= reach * (self.den - self.num))
            .drop("least"), "jaccard-mixed")

    def in_blocks(self, bucket: DataFrame, pivots: DataFrame) -> DataFrame:
        """Pairs of members and pivots of a key that may be linked, compared block by
        block inside tasks: a key's members are dealt over blocks of about ``BLOCK``,
        its pivots go to each of them."""
        num, den = self.num, self.den
        sizes = bucket.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        sizes = written(sizes, "jaccard-blocks")
        total = bucket.count()
        part = F.pmod(F.xxhash64("key", "blk"), F.lit(max(1, -(-total // BLOCK_ROWS)))).alias("part")
        cols = ["key", F.col("blk").cast("long").alias("blk"), "doc", "n", F.col("place").cast("long").alias("place"), "c", "short"]
        short = self.sketches.select("doc", "short")

        def dealt(rows: DataFrame, blk: Column) -> DataFrame:
            rows = join_small(short, rows.select("key", "doc", "n", "place", "c"), "doc", row_bytes=64)
            return join_small(rows, sizes, "key").withColumn("blk", blk).select(part, *cols)

        members = dealt(bucket, F.pmod(F.xxhash64("doc"), F.col("blocks")))
        chosen = written(dealt(pivots, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))), "jaccard-dealt")
        return members.groupBy("part").cogroup(chosen.groupBy("part")).applyInArrow(
            lambda m, p: near_pairs(m, p, num, den), "a long, b long")

    def rounds(self, bucket: DataFrame, most: int | None) -> DataFrame | None:
        """Up to ``most`` pivot rounds (None: until done, with many pivots at once)
        over ``bucket(key, doc, n, place)``. Returns the rows of keys that
        still hold several components, or None."""
        done, width = 0, 1
        if most is None:
            bucket, width = self.mixed(bucket), FIRST_PIVOTS
            if bucket.isEmpty():
                return None
            pivots = self.pivots(bucket, width)
        else:
            bucket = bucket.withColumn("c", F.col("doc"))
            pivots = bucket.groupBy("key").agg(F.min(F.struct("place", "doc", "n", "c")).alias("p")).select("key", "p.*")
            pivots = written(pivots, "jaccard-pivots")
        while True:
            chosen = pivots.select("key", F.col("doc").alias("pivot"), F.col("n").alias("pn"),
                                   F.col("place").alias("pp"), F.col("c").alias("pc"))
            if most is None:
                pairs = self.in_blocks(bucket, pivots)
            else:
                pairs = bucket.join(chosen, "key").where("doc <> pivot AND c <> pc").where(
                    self.may_link(F.col("n"), F.col("pn"), F.col("place") + F.col("pp")))
                pairs = pairs.select(F.least("pivot", "doc").alias("a"), F.greatest("pivot", "doc").alias("b"))
            self.compare(pairs.distinct())
            rest = join_small(bucket.drop("c"), pivots.select("key", "doc"), ["key", "doc"], "left_anti")
            bucket = self.mixed(rest)
            if bucket.isEmpty():
                return None
            done += 1
            if most is not None and done >= most:
                return bucket.select("key", "doc")
            if most is None:
                width = 4 * width if width >= MANY_PIVOTS else MANY_PIVOTS
            pivots = self.pivots(bucket, width)

    def pivots(self, bucket: DataFrame, width: int) -> DataFrame:
        """Next pivots: members of the key's smallest components, so one stranger among
        many copies ends in one round."""
        groups = bucket.groupBy("key", "c").agg(F.count("*").alias("k"), F.min(F.struct("place", "doc", "n")).alias("p"))
        rank = F.row_number().over(Window.partitionBy("key").orderBy("k", "p"))
        return written(groups.withColumn("rank", rank).where(F.col("rank") <= width)
                       .select("key", "p.place", "p.doc", "p.n", "c"), "jaccard-pivots")


@tidy
def ngram_jaccard(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's (doc_id, n_shingles, component_id) under links of Jaccard
    similarity >= num/den between sets of word n-grams; see the module text."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    rows, copies, bucket = _candidates(docs, n, num, den)
    roots = _roots(docs, rows, copies, bucket, n, num, den).select(F.col("id").alias("rep"), "root")
    whole = join_small(rows, copies, ["doc", "fp1", "fp2"], "left").withColumn("rep", F.coalesce("rep", "doc"))
    return join_small(whole, roots, "rep", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("root", "rep").alias("component_id"))


@tidy
def _candidates(docs: DataFrame, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every row's set size and fingerprint, the copies of equal sets, and the index keys
    that several documents have. The keys of all documents, as large as their texts, go here."""
    sig = written(signatures(docs, n, num, den), "jaccard-signatures")
    rows = written(sig.select("doc", "n", "fp1", "fp2"), "jaccard-rows")
    named = rows.where("n > 0 AND doc IS NOT NULL")
    equal = named.groupBy("fp1", "fp2").agg(F.min("doc").alias("rep"), F.max("doc").alias("last"))
    copies = written(named.join(equal.where("rep <> last"), ["fp1", "fp2"]).where("doc <> rep")
                     .select("doc", "fp1", "fp2", "rep").distinct(), "jaccard-copies")

    def originals(s: DataFrame) -> DataFrame:
        return join_small(s, copies.select("doc", "fp1", "fp2"), ["doc", "fp1", "fp2"], "left_anti")

    keys = originals(sig).select("doc", "n", F.explode("keys").alias("key"))
    if not sig.where("lacking").isEmpty():
        single = written(signatures(docs, n, num, den, single=True), "jaccard-single")
        wanted = sig.where("lacking").select("doc").distinct()
        each = originals(single).select("doc", "n", F.explode("keys").alias("key"))
        keys = keys.union(each.join(each.join(wanted, "doc").select("key").distinct(), "key", "left_semi"))
    # A key and its count are all that is shuffled of the keys that one document has.
    several = keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    several = written(several.select("key"), "jaccard-keys")
    # Keys grow with the corpus: they are shuffled at every size.
    bucket = written(keys.join(several.hint("merge"), "key", "left_semi").distinct(), "jaccard-bucket")

    return rows, copies, bucket


@tidy
def _roots(docs: DataFrame, rows: DataFrame, copies: DataFrame, bucket: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(id, root) of the documents that have links."""
    bucket = bucket.select("key", "doc", F.col("n").cast("long").alias("n"), F.lit(0).alias("place"))
    links = _Links(docs, written(bucket.select("doc").distinct(), "jaccard-ids"), n, num, den)
    left = links.rounds(bucket, 1)
    if left is not None:
        _allocate_anew(links, left, num, den)

    edges = copies.join(rows.where("doc IS NOT NULL").select("doc", "fp1").distinct()
                        .groupBy("doc").count().where("count > 1"), "doc").select(
        F.col("doc").alias("a"), F.col("rep").alias("b"))
    edges = written(edges, "jaccard-texts")
    roots = links.roots
    if not edges.isEmpty():
        roots = written(components(edges.union(roots.select(F.col("id").alias("a"), F.col("root").alias("b")))),
                        "jaccard-roots")
    return roots


def _allocate_anew(links: _Links, left: DataFrame, num: int, den: int) -> None:
    """Index the documents of the costly keys ``left`` by their H+1 rarest elements
    and compare until every key holds one component."""
    parts = written(left.select("doc").distinct(), "jaccard-parts")
    sets = written(join_small(links.sets.select("doc", "s"), parts, "doc", "left_semi"), "jaccard-part-sets")

    def slots(u: np.ndarray) -> np.ndarray:
        return (mix(u) >> U64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)

    def count(batches):
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            total += np.bincount(slots(np.asarray(batch.column("s").flatten()).view(U64)), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["x", "f"])

    often = np.zeros(COUNTERS, dtype=np.int64)
    sums = sets.select("s").mapInArrow(count, "x long, f long").groupBy("x").agg(F.sum("f").alias("f")).toArrow()
    often[np.asarray(sums["x"])] = np.asarray(sums["f"])  # at most COUNTERS numbers
    sent = sets.sparkSession.sparkContext.broadcast(often)

    def rarest(batches):
        often = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                u = np.asarray(batch.column("s")[i].values).view(U64)
                need = most_differing(len(u), len(u) * den // num, num, den) + 1
                first = np.lexsort((u, often[slots(u)]))[:need]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), batch.column("doc")[i].as_py())), i64(mix(u[first])),
                     pa.array(np.full(len(first), len(u))), pa.array(np.arange(len(first), dtype=np.int32))],
                    names=["doc", "key", "n", "place"])

    rows = sets.mapInArrow(rarest, "doc long, key long, n long, place int")
    rows = written(rows, "jaccard-rarest")
    drop(sets)  # as large as their texts
    several = rows.groupBy("key").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).where("x <> y").select("key")
    bucket = written(rows.join(several, "key", "left_semi"), "jaccard-bucket")
    if not bucket.isEmpty():
        links.rounds(bucket, None)


@query("op1_ngram_jaccard_join")
def op1_ngram_jaccard_join(spark, sf_dir):
    return ngram_jaccard(table(spark, sf_dir, "documents"), n=4, num=85, den=100)
