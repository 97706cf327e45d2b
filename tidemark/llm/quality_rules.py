"""Quality rules from repetition (operator 4).

Each text is a sequence of words ``[^\\x20\\x09-\\x0D]+``.  A suffix array over the words of a
chunk of texts is built by prefix doubling, only the suffixes that still tie being
sorted again; ranks of the rounds give the longest common prefix (LCP) of neighbours.
A word's longest repeat is the larger LCP of its suffix with its two neighbours in the
array: the LCP interval of that value is the maximal repeated substring starting there.
The union of the spans of all repeats of at least ``min_words`` words is the covered part.

Cases: a null or empty text has no words, all counts 0 and fails the base rules; equal rows are
judged alike; a text is always taken whole; an empty table gives no rows; further
columns of the input pass through ``quality_filter`` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import named, python_map, schema_with, spare
from tidemark.llm.words import SPACED, Words, chain, chunks, covered, mix, per_row, words_of

#: Base rules of the contract.
MIN_TEXT_WORDS, MAX_REPEAT_PERCENT, SYMBOLS = 50, 50, "#*$%&|<>"
#: A repeat counts from so many words on; limits on what repeats cover and on the longest one, both as shares of the text's words.
#: Covered words lie in 3-word windows found twice as well, so limits at or above the base rule's would reject nothing more.
MIN_REPEAT_WORDS, MAX_COVERED, MAX_LONGEST = 8, 0.3, 0.2
#: Text bytes measured at once (a longer text whole): the ranks of all rounds, tens of times as much, are held till its end.
_AT_ONCE = 1 << 20

_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]
_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in _COLUMNS) + ",spans:array<struct<first:int,words:int>>>"


def longest_repeats(words: Words) -> np.ndarray:
    """Per word, the length in words of the longest substring that starts there and occurs again in its text."""
    n = len(words.hash)
    out = np.zeros(n, np.int64)
    if not n:
        return out
    end = words.first[1:][words.doc]
    # rank 0: words by value within their text; ties share a rank, which is the group's first place
    key = chain(mix(words.doc.astype(np.uint64)), words.hash)
    order = np.argsort(key, kind="stable")
    rank = _ranks(order, key[order][1:] != key[order][:-1])
    levels, step, active = [rank], 1, _tied(rank, order)
    array = order
    while len(active):
        after = active + step
        follow = np.where(after < end[active], rank[np.minimum(after, n - 1)], -1)
        own = rank[active]
        by = np.lexsort((follow, own))
        active, own, follow = active[by], own[by], follow[by]
        head = np.r_[True, own[1:] != own[:-1]]
        fresh = head | np.r_[True, follow[1:] != follow[:-1]]
        place = np.arange(len(active))
        base = own + place - np.maximum.accumulate(np.where(head, place, 0))  # place in the array
        new = rank.copy()
        new[active] = base[np.maximum.accumulate(np.where(fresh, place, 0))]
        array = array.copy()
        array[base] = active
        rank = new
        levels.append(rank)
        step *= 2
        same = ~fresh
        tied = same | np.r_[same[1:], False]
        active = active[tied]
    # LCP of neighbours, from the widest round down
    a, b = array[:-1], array[1:]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        at, bt = a + lcp, b + lcp
        live = (at < end[a]) & (bt < end[b]) & (words.doc[a] == words.doc[b])
        at, bt = at[live], bt[live]
        equal = (levels[k][at] == levels[k][bt]) & (words.doc[at] == words.doc[bt])
        lcp[np.flatnonzero(live)[equal]] += 1 << k
    lcp = np.minimum(lcp, np.minimum(end[a] - a, end[b] - b))
    np.maximum.at(out, a, lcp)
    np.maximum.at(out, b, lcp)
    return out


def _ranks(order: np.ndarray, differs: np.ndarray) -> np.ndarray:
    place = np.arange(len(order))
    first = np.maximum.accumulate(np.where(np.r_[True, differs], place, 0))
    rank = np.empty(len(order), np.int64)
    rank[order] = first
    return rank


def _tied(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    same = rank[order][1:] == rank[order][:-1]
    return order[np.r_[same, False] | np.r_[False, same]] if len(order) > 1 else order[:0]


def _lines(words: Words) -> np.ndarray:
    """Per text, the lines with a word that equal an earlier line."""
    data, offsets = words.data, words.offsets
    out = np.zeros(words.n, np.int64)
    breaks = np.flatnonzero(data == 10)
    at = np.searchsorted(breaks, offsets)
    raw = data.tobytes()
    for row in np.flatnonzero(np.diff(at) > 0):  # a text of one line repeats none
        lines = raw[offsets[row]: offsets[row + 1]].split(b"\n")
        seen: set[bytes] = set()
        for line in lines:
            if line in seen:
                out[row] += bool(line.strip(b" \t\n\x0b\x0c\r"))
            else:
                seen.add(line)
    return out


def measure(words: Words, min_words: int) -> dict[str, np.ndarray]:
    """All counts of a chunk's texts, and the merged spans of repeats."""
    data, offsets = words.data, words.offsets
    n = len(words.hash)
    points = (data & 0xC0) != 0x80
    in_word = SPACED.is_word[data]
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True
    grams, at = words.grams(3)
    key = chain(mix(words.doc[at].astype(np.uint64)), grams)
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = at[counts[inverse] >= 2]
    longest = longest_repeats(words)
    start = np.flatnonzero(longest >= min_words)
    cover = covered(n, start, longest[start])
    out = {
        "n_words": np.diff(words.first),
        "word_chars": per_row(points & in_word, offsets),
        "n_symbols": per_row(symbol[data], offsets),
        "n_dup_lines": _lines(words),
        "n_repeat_words": per_row(covered(n, again, np.full(len(again), 3)), words.first),
        "covered_words": per_row(cover, words.first),
    }
    most = np.zeros(words.n, np.int64)
    np.maximum.at(most, words.doc, longest)
    out["longest_repeat"] = most
    opens = np.flatnonzero(cover & ~(np.r_[False, cover[:-1]] & np.r_[False, words.doc[1:] == words.doc[:-1]][:n]))
    closes = np.flatnonzero(cover & ~(np.r_[cover[1:], False] & np.r_[words.doc[1:] == words.doc[:-1], False][:n])) + 1
    out["span_doc"] = words.doc[opens] if n else opens
    out["span_first"] = opens - words.first[out["span_doc"]]
    out["span_words"] = closes - opens
    return out


def _measured(min_words: int, text: str, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(batch.schema.get_field_index(text)), _AT_ONCE):
                m = measure(words_of(data, offsets, SPACED), min_words)
                ends = np.searchsorted(m["span_doc"], np.arange(end - row + 1)).astype(np.int32)
                span = pa.StructArray.from_arrays(
                    [pa.array(m["span_first"].astype(np.int32)), pa.array(m["span_words"].astype(np.int32))], ["first", "words"])
                found = pa.StructArray.from_arrays(
                    [*(pa.array(m[c].astype(np.int64)) for c in _COLUMNS), pa.ListArray.from_arrays(pa.array(ends), span)], [*_COLUMNS, "spans"])
                part = batch.slice(row, end - row)
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, into])
    return run


def repetition(docs: DataFrame, text: str = "text", min_words: int = MIN_REPEAT_WORDS, into: str = "repetition") -> DataFrame:
    """``docs`` with a struct column ``into`` (``spare`` of it, if there is one): the counts, and the spans that repeats cover (word offsets)."""
    into = spare(docs, into)
    return python_map(docs, _measured(min_words, text, into), schema_with(docs, into, _TYPE))


def verdict(m: Column) -> tuple[Column, Column]:
    """(base_failed, kept) of a struct that :func:`repetition` made."""
    base = (m["n_words"] < MIN_TEXT_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    good = (m["covered_words"] <= MAX_COVERED * m["n_words"]) & (m["longest_repeat"] <= MAX_LONGEST * m["n_words"])
    return base, ~base & good


def quality_filter(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the base rules and the repetition limits keep, columns as given."""
    into = spare(docs, "_repetition")
    measured = repetition(docs, text, into=into)
    return measured.filter(verdict(F.col(into))[1]).select(*map(named, docs.columns))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    measured = repetition(docs).drop("text")
    base, kept = verdict(F.col("repetition"))
    return measured.select("doc_id", *(F.col(f"repetition.{c}") for c in _COLUMNS), base.alias("base_failed"), kept.alias("kept"))
