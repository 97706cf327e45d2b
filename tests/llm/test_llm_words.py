"""Word hashing and the numpy helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import quality_rules as Q
from tidemark.llm import words as W

TEXT = st.text(alphabet="ab cß\n\t#9Z\u00a0", max_size=60)


def split(kind, text):
    if kind is W.ALNUM:
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found] if kind is W.SPACED_LOWER else found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_equal_regular_expression(rows):
    for kind in (W.SPACED, W.SPACED_LOWER, W.ALNUM):
        seen = {}
        for row, end, data, offsets in W.chunks(pa.array(rows, pa.string()), 40):
            w = W.words_of(data, offsets, kind)
            for k in range(end - row):
                want = split(kind, rows[row + k] or "")
                got = w.hash[w.first[k]:w.first[k + 1]].tolist()
                assert len(got) == len(want)
                for word, h in zip(want, got, strict=True):
                    assert seen.setdefault(word, h) == h  # the same in every place and chunk
        assert len(set(seen.values())) == len(seen)


def test_hash_across_blocks():
    text = "x" * (W._BLOCK - 3) + " abcdef " + "y" * (2 * W._BLOCK + 5) + " abcdef"
    data, offsets = W.text_bytes(pa.array([text]))
    w = W.words_of(data, offsets, W.SPACED)
    assert len(w.hash) == 4 and w.hash[1] == w.hash[3] and w.hash[0] != w.hash[2]
    alone = W.words_of(*W.text_bytes(pa.array(["y" * (2 * W._BLOCK + 5)])), W.SPACED)
    assert alone.hash[0] == w.hash[2]


def brute_repeats(words):
    """Longest repeat from each place, and its maximum."""
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and words[i + k] == words[j + k]:
                k += 1
            out[i], out[j] = max(out[i], k), max(out[j], k)
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a b c d".split()), max_size=30), min_size=1, max_size=5))
def test_longest_repeats_equal_brute_force(texts):
    data, offsets = W.text_bytes(pa.array([" ".join(t) for t in texts]))
    w = W.words_of(data, offsets, W.SPACED)
    assert Q.longest_repeats(w).tolist() == [x for t in texts for x in brute_repeats(t)]


def test_covered_and_sums():
    assert W.covered(6, np.array([1, 2]), np.array([2, 1])).tolist() == [False, True, True, False, False, False]
    assert W.per_row(np.array([1, 2, 3]), np.array([0, 0, 2, 3])).tolist() == [0, 3, 3]
