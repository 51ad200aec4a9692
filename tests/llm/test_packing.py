import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from keyreport.llm.packing import configurations, linear_program, pack
from keyreport.llm.tokens import JSON, encoder


WHOLE = Tokenizer.from_file(public_tokenizers.path(JSON))


def test_pieces_and_places(documents, rows):
    out = pack(documents, with_ids=True).collect()
    want = []
    for d, text in rows:
        ids = np.array(WHOLE.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for p in range(len(cuts) - 1):
            x = ids[cuts[p]:cuts[p + 1]]
            want.append((str(d), p, cuts[p], len(x), zlib.crc32(x.tobytes()), x.tolist()))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"], r["ids"]) for r in out) == sorted(want)
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by_sequence) <= -(-sum(r["length"] for r in out) // 1024) + 5


def test_empty_table(nothing):
    assert pack(nothing).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
@settings(deadline=None, max_examples=60)
def test_configurations_hold_the_histogram(histogram):
    total = Counter()
    for pattern, uses in configurations(histogram, 64):
        assert uses > 0 and sum(x * k for x, k in pattern.items()) <= 64
        for x, k in pattern.items():
            total[x] += k * uses
    assert total == Counter(histogram)


def test_few_sequences_on_a_mixed_histogram():
    rng = np.random.default_rng(0)
    sizes = np.clip(rng.lognormal(5, 1, 50_000).astype(int), 1, 1024)
    histogram = {int(k): int(v) for k, v in Counter(sizes.tolist()).items()}
    used = sum(uses for _, uses in configurations(histogram, 1024))
    assert used <= 1.002 * -(-int(sizes.sum()) // 1024)


def skewed():
    rng = np.random.default_rng(3)
    yield {532: 4000, 302: 2000, 278: 4000, 206: 6000}
    yield {342: 9000, 171: 3000, 600: 2500, 100: 700}
    for m in (3, 6, 12, 40):
        sizes = rng.choice(np.arange(60, 700), m, replace=False)
        yield {int(x): int(k) for x, k in zip(sizes, rng.integers(500, 20_000, m), strict=True)}
    yield {int(x): int(k) for x, k in zip(range(520, 1000, 4), rng.integers(1, 900, 120), strict=True)}


@pytest.mark.parametrize("histogram", list(skewed()))
def test_few_sequences_on_skewed_histograms(histogram):
    """Close to the configuration program's bound, also where no pattern is full."""
    found = configurations(histogram, 1024)
    total = Counter()
    for pattern, uses in found:
        assert uses > 0 and sum(x * k for x, k in pattern.items()) <= 1024
        total.update({x: k * uses for x, k in pattern.items()})
    assert total == Counter(histogram)
    sizes = np.array(sorted(histogram))
    bound = linear_program(sizes, np.array([histogram[int(x)] for x in sizes]), 1024)[2]
    assert bound <= sum(uses for _, uses in found) <= 1.001 * bound + len(histogram)


def test_the_best_packing_of_patterns_that_are_not_full():
    assert sum(uses for _, uses in configurations({532: 4000, 302: 2000, 278: 4000, 206: 6000}, 1024)) == 5000


def same_ids(text):
    assert encoder().ids_bytes(text) == np.array(WHOLE.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("text", ["a\n b", "a \nb", "a\n \nb", " a  b ", "x   y", "  a b", "a\u0085 b", "中 文 a",
                                  "<|endoftext|> a", "it's 'll 12 34!!", "\t \t a b", "café über ɐ b"])
def test_fast_ids_equal_the_tokenizer(text):
    same_ids(text)


@given(st.text(alphabet=" \n\tab1'.é \u0085中", max_size=30))
@settings(deadline=None, max_examples=400)
def test_fast_ids_equal_the_tokenizer_on_any_text(text):
    same_ids(text)
