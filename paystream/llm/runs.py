"""Runs of words that repeat periodically, and texts with each run cut to its first period.

A run is found from its Lyndon root: under one of the two orders of the words, the longest
Lyndon word that starts at some place of the run is its period. So each place gives one
candidate an order; extending it to both sides takes two longest-common-extension queries, which
are depths of lowest common ancestors in the suffix trees of the words and of their reversal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paystream.llm.common import bare, text_groups
from paystream.llm.hashing import mix, run_hashes, word_hashes

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_GROUP = 1_000_000
_BLOCK = 16
_ROUNDS = 8


def suffix_tree(text: list[int]) -> tuple[list[int], list[int], list[dict[int, int] | None]]:
    """Ukkonen's suffix tree of ``text``, whose last symbol stands nowhere else in it.

    Returns where the edge into each node starts and stops in the text, and the children by
    first symbol. Node 0 is the root; leaves have no children and arise in the order of their suffixes.
    """
    n = len(text)
    start, stop, link = [0], [0], [0]
    children: list[dict[int, int] | None] = [{}]
    node, edge, length, open_suffixes = 0, 0, 0, 0
    for i, symbol in enumerate(text):
        unlinked = 0
        open_suffixes += 1
        while open_suffixes:
            if not length:
                edge = i
            first = text[edge]
            child = children[node].get(first)
            if child is None:
                children[node][first] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                children.append(None)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                begin = start[child]
                span = min(stop[child], i + 1) - begin
                if length >= span:
                    node, edge, length = child, edge + span, length - span
                    continue
                if text[begin + length] == symbol:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                middle, leaf = len(start), len(start) + 1
                start += [begin, i]
                stop += [begin + length, n]
                link += [0, 0]
                children += [{text[begin + length]: child, symbol: leaf}, None]
                children[node][first] = middle
                start[child] = begin + length
                if unlinked:
                    link[unlinked] = middle
                unlinked = middle
            open_suffixes -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - open_suffixes + 1
    return start, stop, children


class Extensions:
    """Longest common extensions of the places of a sequence, in constant time each.

    The Euler tour of the suffix tree is kept as depths in symbols. Of two leaves, the least
    depth between their first visits is that of their lowest common ancestor. Minima of blocks
    of 16 visits are tabulated for all powers of two; within blocks, minima from the start and
    to the end are, so memory is linear.
    """

    def __init__(self, symbols: list[int], ordered: bool = False) -> None:
        n = len(symbols)
        start, stop, self._children = suffix_tree([*symbols, -1])
        depth = [0] * len(start)
        tour: list[int] = []
        first = np.zeros(n + 1, "i8")
        leaves: list[int] = []
        stack: list[tuple[int, Iterator[int]]] = [(0, iter(self._sorted(0)))]
        tour.append(0)
        while stack:
            node, rest = stack[-1]
            child = next(rest, None)
            if child is None:
                stack.pop()
                if stack:
                    tour.append(depth[stack[-1][0]])
                continue
            deep = depth[child] = depth[node] + stop[child] - start[child]
            if self._children[child] is None:
                leaf = n + 1 - deep
                first[leaf] = len(tour)
                leaves.append(leaf)
                tour += [deep, depth[node]]
            else:
                tour.append(deep)
                stack.append((child, iter(self._sorted(child))))
        self._first, self._n = first, n
        if ordered:
            self.ranks = [self._ranks(leaves), self._ranks(self._reversed_leaves(depth, n))]
        del self._children
        blocks = -(-len(tour) // _BLOCK)
        self._tour = np.full(blocks * _BLOCK, n + 2, "i4")
        self._tour[:len(tour)] = tour
        square = self._tour.reshape(blocks, _BLOCK)
        self._from_start = np.minimum.accumulate(square, axis=1).ravel()
        self._to_end = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        self._table = [square.min(axis=1)]
        while 2 << len(self._table) - 1 <= blocks:
            half = 1 << len(self._table) - 1
            self._table.append(np.minimum(self._table[-1][:-half], self._table[-1][half:]))

    def _sorted(self, node: int) -> list[int]:
        return [x for _, x in sorted(self._children[node].items())]

    def _reversed_leaves(self, depth: list[int], n: int) -> list[int]:
        """The suffixes in the order of the reversed alphabet, where the end still comes first."""
        leaves, stack = [], [0]
        while stack:
            node = stack.pop()
            if self._children[node] is None:
                leaves.append(n + 1 - depth[node])
            else:  # the last on the stack comes first
                kids = self._sorted(node)
                stack += kids if -1 not in self._children[node] else [*kids[1:], kids[0]]
        return leaves

    @staticmethod
    def _ranks(leaves: list[int]) -> np.ndarray:
        ranks = np.empty(len(leaves), "i8")
        ranks[leaves] = np.arange(len(leaves))
        return ranks

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols are equal from places ``a`` and ``b`` on; these differ, and may be the end."""
        x, y = self._first[a], self._first[b]
        x, y = np.minimum(x, y), np.maximum(x, y)
        p, q = x // _BLOCK, y // _BLOCK
        out = np.minimum(self._to_end[x], self._from_start[y])
        level = np.frexp(np.maximum(q - p - 1, 1))[1] - 1
        for k, row in enumerate(self._table):
            at = np.flatnonzero((level == k) & (q - p > 1))
            if len(at):
                out[at] = np.minimum(out[at], np.minimum(row[p[at] + 1], row[q[at] - (1 << k)]))
        near = np.flatnonzero(p == q)
        if len(near):
            u, v = x[near], y[near]
            least = self._tour[u]
            for k in range(1, _BLOCK):
                least = np.minimum(least, self._tour[np.minimum(u + k, v)])
            out[near] = least
        return out


def _lyndon(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from each place: up to the next smaller suffix."""
    values = ranks.tolist()
    n = len(values) - 1  # the last one is the end, which is smaller than all
    out = np.zeros(n, "i8")
    stack: list[int] = []
    for i, value in enumerate(values):
        while stack and values[stack[-1]] > value:
            j = stack.pop()
            out[j] = i - j
        stack.append(i)
    return out


def find_runs(symbols: list[int], least: int = 12) -> np.ndarray:
    """All runs (start, length, period) of at least ``least`` symbols and two periods, in order."""
    n = len(symbols)
    ahead = Extensions(symbols, ordered=True)
    found = []
    back: Extensions | None = None
    for ranks in ahead.ranks:
        period = _lyndon(ranks)
        start = np.flatnonzero(2 * period <= n)
        period = period[start]
        right = ahead.of(start, start + period)
        if back is None:
            back = Extensions(symbols[::-1])
        left = back.of(n - start, n - start - period)
        length = left + period + right
        good = length >= np.maximum(2 * period, least)
        found.append(np.stack([start - left, length, period], axis=1)[good])
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def stretches(hashes: np.ndarray, starts: np.ndarray, least: int = 12) -> np.ndarray:
    """Places of words (from, to) outside of which no run can lie.

    A run of ``least`` words or two periods repeats its first ``least / 2`` words (rounded up) a
    period later, and so on with each word on the way, until its last words have been repeated.
    So it lies within words covered by sequences of that length that stand twice, at most half the
    stretch apart. What is left is looked through again while that helps, at most ``_ROUNDS``
    times. Words are told apart by hashes here: where two are equal by chance, or after the last
    round, a stretch is only longer than it needs to be.
    """
    width = (least + 1) // 2
    grams = run_hashes(hashes, width)
    n = len(hashes)
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    alive = np.ones(n, bool)
    for _ in range(_ROUNDS):
        bounds = np.diff(alive.view("i1"), prepend=0, append=0)
        begin = (bounds[:-1] == 1) | (edge[:-1] & alive)
        group = np.cumsum(begin) - 1
        first = np.flatnonzero(begin)
        size = np.bincount(group[alive], minlength=len(first))
        at = np.flatnonzero(alive[:len(grams)])
        at = at[at + width <= (first + size)[group[at]]]
        # Sequences of the same words in the same stretch, side by side in order of place.
        key = grams[at] ^ mix(group[at].astype("u8") + np.uint64(1))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        near = same & (2 * np.diff(at[order]) <= size[group[at[order]]][1:])
        twice = np.zeros(len(at), bool)
        twice[order[1:][near]] = twice[order[:-1][near]] = True
        cover = np.zeros(n + 1, "i8")
        np.add.at(cover, at[twice], 1)
        np.add.at(cover, at[twice] + width, -1)
        left = np.cumsum(cover[:-1]) > 0
        if left.sum() == alive.sum():
            break
        alive = left
    return np.stack([first, first + size], axis=1)


def _symbols(words: list[bytes]) -> list[int]:
    ids: dict[bytes, int] = {}
    return [ids.setdefault(w, len(ids)) for w in words]


def _judge(texts: list[bytes], least: int) -> tuple[np.ndarray, list[list[tuple]], list[bytes]]:
    """Number of words, runs, and the collapsed form of each text."""
    hashes, starts = word_hashes(texts)
    found: dict[int, list[np.ndarray]] = {}
    held: dict[int, list[bytes]] = {}
    places = stretches(hashes, starts, least)
    owners = np.searchsorted(starts, places[:, 0], side="right") - 1
    for (a, b), k in zip(places.tolist(), owners.tolist()):
        if k not in held:
            held[k] = texts[k].split()
        runs = find_runs(_symbols(held[k][a - starts[k]:b - starts[k]]), least)
        if len(runs):
            runs[:, 0] += a - starts[k]
            found.setdefault(k, []).append(runs)
    all_runs: list[list[tuple]] = [[] for _ in texts]
    collapsed = []
    for k, text in enumerate(texts):
        words = held.pop(k, None) or text.split()
        if k in found:
            runs = np.concatenate(found[k])
            all_runs[k] = list(map(tuple, runs.tolist()))
            cover = np.zeros(len(words) + 1, "i8")
            np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
            np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
            words = [w for w, c in zip(words, np.cumsum(cover).tolist()) if not c]
        collapsed.append(b" ".join(words))
    return np.diff(starts), all_runs, collapsed


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """The periodic runs of every whole text, and the text without their repeats: RUNS.

    Words are what stands between blanks. A run is a stretch of consecutive words with smallest
    period q and at least ``least`` words and 2 q that no neighbouring word extends; ``runs`` has
    all of them, by start and period. ``collapsed`` has the words, joined by one space, that do
    not lie in a run beyond its first q words.

    Texts are judged where they lie, nothing is shuffled. The trees are built for the stretches
    of a text in which a run can lie (``stretches``), with about 600 bytes a word of the longest
    one. Null, empty and blank texts have no words, no runs and are empty when collapsed; a null
    id stays null; repeated rows are judged each; an empty table gives no rows; other columns are
    ignored. Runs of equal start are ordered by period; equal ones are one run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_groups(batches, _GROUP):
            n, runs, collapsed = _judge(texts, least)
            rows = [[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n), pa.array(rows, pa.list_(_RUN)), pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return bare(docs).mapInArrow(run, RUNS)
