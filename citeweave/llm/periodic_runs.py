"""Periodic runs of words by Kruskal's order over suffix classes, and their removal.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and a length of at least max(MIN_LENGTH, 2 * q) that no
neighbouring word extends with that period.

A text's suffixes are sorted by prefix doubling, and neighbours in that order
are joined by edges that weigh their longest common prefix (LCP). Edges are
taken by descending LCP, as Kruskal would: each unites two classes of suffixes,
kept as ordered position sets, by a union-find. Two positions that become
neighbours in the united set at a distance of at most that LCP seed a run:
positions p and p + q with LCP l agree on l >= q words, so q + l words from p
have period q, and no smaller one, since its position would lie between them
in the set. The run is that stretch if the word before p does not go on with
it. Every run is found so, from its first word.

A run needs an LCP of max(q, MIN_LENGTH - q), half of MIN_LENGTH at least, so the
order goes no further down than that, only positions whose first words of
that number occur again in their text take part, and a class whose closest
positions lie further apart than its greatest LCP seeds nothing.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` and are compared by 64-bit hashes.
Every text is one task's work in slices of a bounded size (a longer text is
handled alone), nothing is shuffled, and a lost executor repeats its slices.

Defined results: a null text, or one without a word, has no words and no runs
and collapses to the empty text. Rows are judged each by itself, so repeated rows
give equal results. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from citeweave.llm.common import slices
from citeweave.llm.words import hashes

MIN_LENGTH = 12
RESULT = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"

_WEIGHTS = np.random.default_rng(13).integers(0, 2**64, 256, np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, offsets of the texts' words)."""
    solid = ~_BLANK[raw]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(raw)]
    begins[firsts] |= solid[firsts]
    at = np.flatnonzero(begins)
    place = np.concatenate([[0], np.cumsum(solid)])
    return hashes(_WEIGHTS[raw[solid]], place[at]), np.searchsorted(at, offsets)


def _repeated(words: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """For each position whether the ``width`` words from it occur again in the same text."""
    out = np.zeros(len(words), bool)
    many = len(words) - width + 1
    if many < 2:
        return out
    odd = np.random.default_rng(width).integers(0, 2**63, width, np.uint64) * np.uint64(2) + np.uint64(1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    key = text[:many].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(width):
        key += words[k:k + many] * odd[k]
    whole = text[:many] == text[width - 1:]
    order = np.sort(key[whole])
    again = order[1:][order[1:] == order[:-1]]
    if len(again):
        place = np.minimum(np.searchsorted(again, key), len(again) - 1)
        out[:many] = whole & (again[place] == key)
    return out


def _dense(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1]


def _sorted_suffixes(words: np.ndarray, text: np.ndarray, end: np.ndarray, chosen: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The chosen positions by text and suffix, and of each the LCP with the one before
    it, 0 if that is under ``width``. end: where each position's text ends."""
    n = len(words)
    at = np.arange(n)

    def after(rank: np.ndarray, k: int, where: np.ndarray = at) -> np.ndarray:
        """1 + the rank k positions on, 0 beyond the text."""
        inside = where + k < end[where]
        return np.where(inside, rank[np.minimum(where + k, n - 1)] + 1, 0)

    first = _dense(words)
    rank, k = first, 1
    while k < width:  # by the first k words; ranks are dense
        step = min(k, width - k)
        rank = _dense(rank * np.int64(n + 2) + after(rank, step))
        k += step
    key = text * np.int64(n + 1) + rank
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order][1:] != key[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]  # place of the class's first
    levels, h = [rank], width
    tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(tied):
        own, following = rank[tied], after(rank, h, tied)
        order = np.lexsort((following, own))
        own, following = own[order], following[order]
        group = np.append(True, own[1:] != own[:-1])
        new = group | np.append(True, following[1:] != following[:-1])
        begin = np.flatnonzero(group)[np.cumsum(group) - 1]
        rank = rank.copy()
        rank[tied[order]] = own + np.flatnonzero(new)[np.cumsum(new) - 1] - begin
        levels.append(rank)
        h *= 2
        size = np.diff(np.append(np.flatnonzero(new), len(new)))
        tied = tied[order][np.repeat(size > 1, size)]
    chosen = chosen[np.argsort(rank[chosen])]
    a, b = chosen[:-1].copy(), chosen[1:].copy()
    lcp = np.zeros(len(a), np.int64)

    def advance(same: np.ndarray, k: int) -> None:
        lcp[same] += k
        a[same] += k
        b[same] += k

    def both_inside() -> np.ndarray:
        return np.flatnonzero((a < end[chosen[:-1]]) & (b < end[chosen[1:]]))

    for k in range(len(levels) - 1, -1, -1):
        inside = both_inside()
        advance(inside[levels[k][a[inside]] == levels[k][b[inside]]], width << k)
    going = np.flatnonzero(lcp >= width)
    for _ in range(width - 1):
        going = going[(a[going] < end[chosen[:-1]][going]) & (b[going] < end[chosen[1:]][going])]
        going = going[first[a[going]] == first[b[going]]]
        advance(going, 1)
    return chosen, np.concatenate([[0], np.where(lcp >= width, lcp, 0)])


def _seeds(order: np.ndarray, lcp: np.ndarray, min_length: int) -> list[tuple[int, int, int]]:
    """(position, period, LCP) of all pairs that become neighbours at a distance of at most their LCP."""
    out = []
    positions = order.tolist()
    classes: list = [[p] for p in positions]  # at the first and the last index of each class
    low, high = list(range(len(order))), list(range(len(order)))
    edges = np.flatnonzero(lcp)
    for e, common in zip((by := edges[np.argsort(-lcp[edges], kind="stable")]).tolist(), lcp[by].tolist()):
        left, right = low[e - 1], high[e]
        small, large = classes[e - 1], classes[e]
        if len(small) > len(large):
            small, large = large, small
        farthest, last = min_length - common, len(small) - 1
        for i, x in enumerate(small):
            k = bisect_left(large, x)
            if k:
                q = x - large[k - 1]
                if farthest <= q <= common and (not i or small[i - 1] < large[k - 1]):
                    out.append((x - q, q, common))
            if k < len(large):
                q = large[k] - x
                if farthest <= q <= common and (i == last or small[i + 1] > large[k]):
                    out.append((x, q, common))
        if len(small) == 1:
            large.insert(bisect_left(large, small[0]), small[0])
        else:
            large += small
            large.sort()  # two ordered stretches: a merge
        classes[left] = classes[right] = large
        low[right], high[left] = left, right
    return out


def find_runs(words: np.ndarray, offsets: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period."""
    width = (min_length + 1) // 2
    repeated = _repeated(words, offsets, width)
    nothing = tuple(np.zeros(0, np.int64) for _ in range(4))
    if not repeated.any():
        return nothing
    every = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    has = np.zeros(len(offsets) - 1, bool)
    has[every[repeated]] = True
    here = np.flatnonzero(has[every])  # all words of the texts that take part
    text, end = every[here], np.searchsorted(here, offsets[1:])[every[here]]
    chosen = np.flatnonzero(repeated[here])
    order, lcp = _sorted_suffixes(words[here], text, end, chosen, width)
    # Classes that share ``width`` words; none of them can seed a run whose closest positions lie too far apart.
    part = np.cumsum(lcp == 0) - 1
    by = np.lexsort((order, part))
    gap = np.where(part[by][1:] == part[by][:-1], np.diff(order[by]), len(here) + 1)
    closest = np.full(part[-1] + 1, len(here) + 1)
    np.minimum.at(closest, part[by][1:], gap)
    longest = np.zeros(part[-1] + 1, np.int64)
    np.maximum.at(longest, part, lcp)
    worth = (closest <= longest)[part]
    seeds = _seeds(order[worth], lcp[worth], min_length)
    if not seeds:
        return nothing
    p, q, common = np.array(seeds, np.int64).T
    w = words[here]
    begin = offsets[:-1][text[p]]  # of the text, among all words
    maximal = (here[p] == begin) | (w[p - 1] != w[p + q - 1])
    p, q, common, begin = p[maximal], q[maximal], common[maximal], begin[maximal]
    start = here[p] - begin
    by = np.lexsort((q, start, text[p]))
    return text[p][by], start[by], (q + common)[by], q[by]


def _collapsed(texts: pa.Array, min_length: int) -> pa.Array:
    n_words, n_runs, runs, kept = [], [], [], []
    for raw, offsets in slices(texts):
        words, ends = word_hashes(raw, offsets)
        text, start, length, period = find_runs(words, ends, min_length)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, ends[:-1][text] + start + period, 1)
        np.add.at(change, ends[:-1][text] + start + length, -1)
        stays = np.cumsum(change[:-1]) == 0
        data = raw.tobytes()
        losing = np.zeros(len(offsets) - 1, bool)
        losing[text] = True
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            own = data[a:b].split()
            if losing[i]:
                own = [own[k] for k in np.flatnonzero(stays[ends[i]:ends[i + 1]]).tolist()]
            kept.append(b" ".join(own))
        n_words.append(np.diff(ends))
        n_runs.append(np.bincount(text, minlength=len(offsets) - 1))
        runs.append(np.stack([start, length, period]))
    if not kept:
        n_words, n_runs, runs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((3, 0), np.int64)]
    one = pa.StructArray.from_arrays([pa.array(c) for c in np.concatenate(runs, 1)], ["start", "length", "period"])
    ends = np.concatenate([[0], np.cumsum(np.concatenate(n_runs))]).astype(np.int32)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(n_words), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), one),
                                       pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])


def collapse_runs(text: Column, min_length: int = MIN_LENGTH) -> Column:
    """A struct for each text: n_words, runs (start, length, period; by start and
    period), and collapsed: the words that stay, joined by single spaces. A word goes
    if any run contains it after that run's first period."""
    return F.arrow_udf(lambda texts: _collapsed(texts, min_length), RESULT)(text)
