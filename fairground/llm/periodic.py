"""Periodic runs of words: repeated k-gram masking, then Main-Lorentz on the segments that survive.

A run is a stretch of consecutive words with smallest period ``q`` and at least ``max(min_length, min_power * q)`` words that
no neighbouring word extends. A run overlaps itself, moved by its period, in at least ``min_overlap`` words, and each of its
words lies in that overlap or in its copy, so each lies in a k-gram, k = ``min_overlap``, that the document holds twice.
Words outside such k-grams are masked. What is left falls into segments, and each segment is taken apart by halves: a run
is found at the centre of the smallest block that holds it, by how far the words agree to both sides of a centre and of the
place one period on. All centres of one block size, of all documents of a slice, are tried at once.

The masking works on hashes and can only keep too much; what is a run is decided on the words themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from fairground.llm.common import concat, free_name, mix, slices, split_words, text_column

#: Bytes of text that a task takes apart at a time; a longer text is taken by itself.
SLICE = 4 << 20
_ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def min_overlap(min_length: int, min_power: int) -> int:
    """The least ``length - period`` of a run, over all periods: beyond period ``min_length`` it only grows."""
    return min(max(min_length, min_power * q) - q for q in range(1, min_length + 1))


def masked(codes: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Which words lie in a k-gram that occurs twice or more in their document."""
    n = len(codes)
    if n < k + 1:
        return np.zeros(n, bool)
    grams = mix(doc[: n - k + 1].astype(np.uint64) + np.uint64(1))
    for j in range(k):
        grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + codes[j : n - k + 1 + j].astype(np.uint64))
    at = np.flatnonzero(doc[: n - k + 1] == doc[k - 1 :])
    at = at[pd.Series(grams[at]).duplicated(keep=False).to_numpy()]
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + k, -1)
    return np.cumsum(edge[:-1]) > 0


class Words:
    """Word codes of several segments, one behind the other, with names for their stretches of 1, 4, 16 ... words.

    Stretches of one length have equal names if and only if their words are equal, so how far two places agree is found in a
    few steps, largest first. The names take four bytes a word for each power of four up to the longest segment.
    """

    def __init__(self, codes: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.begin, self.end = begin, end
        self.names = [pd.factorize(codes)[0].astype(np.int32)]
        longest = int((end - begin).max(initial=0))
        for level in range(1, 31):
            if 4**level > longest:
                break
            width, name = 4 ** (level - 1), self.names[-1]
            for step in (width, 2 * width):
                behind = np.full(len(name), -1, np.int64)
                behind[: max(0, len(name) - step)] = name[step:]
                name = pd.factorize(name.astype(np.int64) << 32 | (behind + 1))[0].astype(np.int32)
            self.names.append(name)

    def ahead(self, i: np.ndarray, q: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on equal those from ``i + q`` on, inside the segment of ``i + q``."""
        n, out = len(self.codes), np.zeros(len(i), np.int64)
        for level in reversed(range(len(self.names))):
            name, width = self.names[level], 4**level
            for _ in range(3):
                here = i + out
                there = here + q
                same = there < n
                same[same] = name[here[same]] == name[there[same]]
                if not same.any():
                    break
                out[same] += width
        return np.minimum(out, self.end[i + q] - (i + q))

    def behind(self, i: np.ndarray, q: np.ndarray) -> np.ndarray:
        """How many words up to ``i`` equal those up to ``i + q``, inside the segment of ``i + 1``."""
        out = np.zeros(len(i), np.int64)
        for level in reversed(range(len(self.names))):
            name, width = self.names[level], 4**level
            for _ in range(3):
                here = i - out - width + 1
                same = here >= 0
                same[same] = name[here[same]] == name[here[same] + q[same]]
                if not same.any():
                    break
                out[same] += width
        return np.minimum(out, i + 1 - self.begin[i + 1])

    @property
    def codes(self) -> np.ndarray:
        return self.names[0]


def main_lorentz(codes: np.ndarray, sizes: np.ndarray, min_length: int, min_power: int) -> np.ndarray:
    """All runs of the segments of ``sizes`` words each, as rows of start, end and period, by start, then period."""
    ends = np.cumsum(sizes)
    begin, end = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
    words, place = Words(codes, begin, end), np.arange(len(codes)) - begin
    room, x = end - begin, words.codes
    half, found = 1, []
    while half < int(sizes.max(initial=0)):
        # A run lies in the block of two halves around the centre that it crosses, so it is no longer than they are.
        if 2 * half >= min_length and 2 * half >= min_power:
            centre = np.flatnonzero((place % (2 * half) == half))
            most = np.minimum(2 * half, room[centre]) // min_power
            m = np.repeat(centre, most)
            q = np.arange(len(m)) - np.repeat(np.cumsum(most) - most, most) + 1
            for pair, first in ((m, m), (m - q, m - 2 * q)):
                if min_power >= 4:
                    # Such a run holds two periods before or behind its centre: their first and last words are compared at once.
                    at = np.flatnonzero((first >= begin[m]) & (first + 2 * q <= end[m]))
                    a, p = first[at], q[at]
                    at = at[(x[a] == x[a + p]) & (x[a + p - 1] == x[a + 2 * p - 1])]
                else:
                    at = np.flatnonzero((pair >= begin[m]) & (pair + q < end[m]))
                i, p = pair[at], q[at]
                left, right = words.behind(i - 1, p), words.ahead(i, p)
                long = left + right + p >= np.maximum(min_length, min_power * p)
                found.append(np.stack([i - left, i + p + right, p], 1)[long])
        half *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # One stretch is found with each multiple of its period; the smallest is the period.
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def find_runs(codes: np.ndarray, bounds: np.ndarray, min_length: int = 6, min_power: int = 4) -> np.ndarray:
    """Runs of documents whose words are ``codes[bounds[d]:bounds[d + 1]]``: start and end in ``codes``, and period."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    kept = masked(codes, doc, min_overlap(min_length, min_power))
    at = np.flatnonzero(kept)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(doc[at]) > 0)) + 1
    starts = np.concatenate([[0], cut])
    sizes = np.diff(np.concatenate([starts, [len(at)]]))
    full = sizes >= min_length
    if not full.any():
        return np.zeros((0, 3), np.int64)
    inside = np.repeat(full, sizes)
    at, sizes = at[inside], sizes[full]
    runs = main_lorentz(codes[at], sizes, min_length, min_power)
    # A segment is a stretch without gaps, so ends move as starts do.
    moved = at[runs[:, 0]] - runs[:, 0]
    return np.stack([runs[:, 0] + moved, runs[:, 1] + moved, runs[:, 2]], 1)


def periodic_runs(docs: DataFrame, min_length: int = 6, min_power: int = 4) -> DataFrame:
    """The columns of ``docs`` with ``runs`` (start, length and period in words) and ``collapsed``, the text without repeats.

    Words are what stands between ASCII white space. ``runs`` are by start, then period; of a run only the first period stays
    in ``collapsed``, whose words are joined by one space. Null and empty texts have no runs and an empty ``collapsed``;
    ``docs`` may have columns of these names: underscores are put behind the new ones then. Each row counts by itself,
    whether its id is null, shared or its text repeated; an empty table gives an empty one. One row is taken by one task: its
    memory is some fifty bytes a word of the longest text, and its time grows with n log n.
    """
    if min_power < 2 or min_length < 2:
        raise ValueError("a run has at least two periods and two words")
    text, runs = free_name("whole_text", *docs.columns), free_name("runs", *docs.columns)
    collapsed = free_name("collapsed", *docs.columns)

    def take(batches):
        for batch in slices(batches, SLICE):
            words, bounds = split_words(concat(batch.columns[-1]))
            codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            found = find_runs(codes, bounds, min_length, min_power)
            edge = np.zeros(len(codes) + 1, np.int64)
            np.add.at(edge, found[:, 0] + found[:, 2], 1)
            np.add.at(edge, found[:, 1], -1)
            kept = np.cumsum(edge[:-1]) == 0
            after = np.concatenate([[0], np.cumsum(kept)])[bounds].astype(np.int32)
            left = pa.ListArray.from_arrays(pa.array(after), words.filter(pa.array(kept)))
            doc = np.searchsorted(bounds, found[:, 0], "right") - 1
            rows = pa.StructArray.from_arrays([pa.array(found[:, 0] - bounds[doc]), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])], ["start", "length", "period"])
            each = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(bounds))).astype(np.int32)), rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], each.cast(_ARROW_RUNS), pc.binary_join(left, " ")], [*batch.schema.names[:-1], runs, collapsed])

    run = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
    schema = StructType([*docs.schema.fields, StructField(runs, ArrayType(run)), StructField(collapsed, StringType())])
    return docs.withColumn(text, text_column(docs).alias(text)).mapInArrow(take, schema)
