"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A seed is an n-gram with gaps: two words in order, at most ``width - 1`` words apart in the item
and as much in the text. Seeds of the test items are counted in all training texts, and the
rarest places of each item are looked for in the texts; where two of them stand within reach of
one copy, all seeds of the item are counted there, and where there are as many as a copy must
have the words are aligned.

No copy is lost by that. Between two words of an alignment that follow each other as matches lie
either so few others that they are a seed, or ``width - 1`` edits or more, which cost at least 2
of the score. So an alignment of score s has at least s / 2 - 1 seeds at different places of its
item, whatever words were inserted, deleted or replaced. Of an item's p places, p - (s / 2 - 1)
may be missing; the rarest p - (s / 2 - 1) + 2 of them have two that stand in the copy. Frequent
n-grams need not be looked for, and none is dropped for being frequent.

The benchmark is the query set: it is taken in blocks of a bounded number of n-grams, and each
block meets every text where it lies, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystream.llm.common import bare, keep_rows, text_groups
from paystream.llm.hashing import mix, word_hashes

#: ASCII signs part words, as blanks do; everything beyond ASCII is part of one.
_SIGNS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_TASK_BYTES = 2_000_000
_BITS = 22
#: Pairs of a place in a text and one in an item that are held at once.
_PAIRS = 2_000_000
#: Words of a passage that counts as a copy, however long its item: unchanged, or more with some changed.
PASSAGE = 25
#: Words that a copy of a short item has at least, unchanged or as many more as changes cost; all, if it has fewer.
FEWEST = 6
#: Words of a part of a long item; parts begin half as many words apart, a passage must lie in one.
PART = 4 * PASSAGE
#: Rare places of an item that a candidate has.
_HITS = 2
FOUND = "doc_id long, item_id long, similarity double, start long, end long, item_words long"


def plain(text: str) -> bytes:
    """A text in lower case with its ASCII signs as blanks."""
    return text.lower().encode().translate(_SIGNS)


def align(item: np.ndarray, passage: np.ndarray, match: int = 2, mismatch: int = 1, gap: int = 1) -> tuple[int, int]:
    """Best local alignment of two runs of word hashes: its score and where it ends in the passage.

    One row of the table at a time; gaps along the row are a running maximum.
    """
    slope = np.arange(len(passage) + 1) * gap
    above = np.zeros(len(passage) + 1, "i4")
    best, end = 0, 0
    for word in item:
        row = np.empty_like(above)
        row[0] = 0
        step = np.where(passage == word, match, -mismatch)
        row[1:] = np.maximum(np.maximum(above[:-1] + step, above[1:] - gap), 0)
        above = np.maximum.accumulate(row + slope) - slope
        top = int(above.argmax())
        if above[top] > best:
            best, end = int(above[top]), top
    return best, end


def _seeds(words: np.ndarray, apart: int) -> np.ndarray:
    """A hash of each word and the one ``apart`` words later, in this order; the distance is not in it."""
    first, second = words[:max(len(words) - apart, 0)], words[apart:]
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29))))


def _places(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The seeds of some words, and the place of the first word of each."""
    parts = [_seeds(words, k) for k in range(1, width)]
    return np.concatenate(parts), np.concatenate([np.arange(len(p)) for p in parts])


@dataclass(frozen=True)
class Block:
    """Some items: their parts, the seeds of these in order, and the (part, place) of each.

    An item of up to ``PART`` words is one part. ``owner`` is the item of each part.
    """

    ids: list[int | None]
    words: list[np.ndarray]
    parts: list[np.ndarray]
    owner: np.ndarray
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray
    width: int

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]], width: int) -> "Block":
        hashes, starts = word_hashes([plain(text) for _, text in rows])
        words = [hashes[starts[k]:starts[k + 1]] for k in range(len(rows))]
        parts, owner = [], []
        for k, known in enumerate(words):
            last = max(len(known) - PART, 0)
            begins = [*range(0, last, PART // 2), last] if len(known) >= width else []
            parts += [known[a:a + PART] for a in begins]
            owner += [k] * len(begins)
        seeds = [_places(p, width) for p in parts]
        item = np.repeat(np.arange(len(parts)), [len(g) for g, _ in seeds])
        place = np.concatenate([p for _, p in seeds]) if seeds else np.zeros(0, "i8")
        flat = np.concatenate([g for g, _ in seeds]) if seeds else np.zeros(0, "u8")
        order = np.argsort(flat, kind="stable")
        return cls([r[0] for r in rows], words, parts, np.array(owner, "i8"), flat[order], item[order], place[order], width)

    @cached_property
    def own(self) -> list[np.ndarray]:
        """The seeds of each part, in order."""
        return [np.sort(_places(p, self.width)[0]) for p in self.parts]

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.array([len(p) for p in self.parts], "i8")

    def limits(self, least: float) -> np.ndarray:
        """The score from which a copy of each part counts."""
        share = np.minimum(2 * least * self.sizes, 2 * PASSAGE)
        return np.maximum(share, 2 * np.minimum(self.sizes, FEWEST))

    def fewest(self, least: float) -> np.ndarray:
        """How many places of each part with a seed a copy has at least."""
        return np.maximum(np.ceil(self.limits(least) / 2 - 1).astype("i8"), 1)

    def sieve(self) -> np.ndarray:
        """A bit for the first bits of each n-gram, which most n-grams of a text don't have."""
        out = np.zeros(1 << _BITS, bool)
        out[self.grams >> np.uint64(64 - _BITS)] = True
        return out

    def hits(self, words: np.ndarray, starts: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Seeds of the texts that the block has, by place: text, first word, where the block's equal ones begin and end."""
        found = []
        for k in range(1, self.width):
            grams = _seeds(words, k)
            maybe = np.flatnonzero(sieve[grams >> np.uint64(64 - _BITS)])
            text = np.searchsorted(starts, maybe, "right") - 1
            inside = maybe + k < starts[text + 1]
            maybe, text = maybe[inside], text[inside]
            low = np.searchsorted(self.grams, grams[maybe], "left")
            high = np.searchsorted(self.grams, grams[maybe], "right")
            real = high > low
            found.append((text[real], maybe[real], low[real], high[real]))
        text, at, low, high = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(at, kind="stable")
        return text[order], at[order], low[order], high[order]

    def rare(self, frequency: np.ndarray, least: float) -> "Block":
        """With the seeds of the rarest places of each part only, as many as two of which a copy must have."""
        width = max((int(n) for n in self.sizes), default=1)
        total = np.bincount(self.item * width + self.place, frequency, minlength=len(self.parts) * width)
        item, place = np.divmod(np.arange(len(total)), width)
        total[place >= self.sizes[item] - 1] = np.inf  # no seed begins at the last word
        rank = np.empty(len(total), "i8")
        rank[np.lexsort((total, item))] = place
        fewest = self.fewest(least)
        most = self.sizes - 1 - fewest + np.minimum(fewest, _HITS)
        keep = rank[self.item * width + self.place] < most[self.item]
        return replace(self, grams=self.grams[keep], item=self.item[keep], place=self.place[keep])


def blocks_of(benchmark: DataFrame, width: int, block_grams: int) -> Iterator[Block]:
    """The items in blocks of about ``block_grams`` n-grams, each of which the driver can hold.

    Items are drawn into blocks by a hash of their rows, so a block is a filter on the table.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    parts = -(-size // block_grams)
    for k in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).orderBy("item_id", "text").collect()
        if rows:
            yield Block.of([(r["item_id"], r["text"]) for r in rows], width)


def frequencies(docs: DataFrame, block: Block) -> np.ndarray:
    """In how many texts each n-gram of the block occurs, over all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sieve = shared.value, shared.value.sieve()
        seen = np.zeros(len(own.grams), "i8")
        for _, texts in text_groups(batches, _TASK_BYTES, plain):
            text, _, low, _ = own.hits(*word_hashes(texts), sieve)
            seen += np.bincount(np.unique(text * len(seen) + low) % max(len(seen), 1), minlength=len(seen))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], ["gram", "n"])

    out = np.zeros(len(block.grams), "i8")
    for r in bare(docs).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["gram"]] = r["n"]
    shared.destroy()
    # Equal n-grams stand together; the first of them was counted.
    return out[np.searchsorted(block.grams, block.grams, "left")]


def matches(texts: list[bytes], block: Block, sieve: np.ndarray, least: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, similarity, start, end) of the best copy of each item in each text."""
    words, starts = word_hashes(texts)
    text, at, low, high = block.hits(words, starts, sieve)
    # A text's hits stay together; texts with many are taken in turn.
    edges = np.flatnonzero(np.diff(text, prepend=-1, append=-1)) if len(at) else np.zeros(1, "i8")
    pairs = np.cumsum(high - low)
    turn = np.flatnonzero(np.diff(pairs[edges[1:] - 1] // _PAIRS, prepend=-1, append=-1)) if len(at) else edges
    for a, b in zip(edges[turn], edges[turn[1:]]):
        yield from _copies(words, starts, text[a:b], at[a:b], low[a:b], high[a:b], block, least)


def _candidates(
    text: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, block: Block, least: float
) -> Iterator[tuple[int, int, int, int]]:
    """(text, part, first and last place) of the hits that stand within reach of each other, if enough of the part's places do."""
    times = high - low
    hit = np.repeat(np.arange(len(at)), times)
    entry = np.arange(len(hit)) - np.repeat(np.cumsum(times) - times, times) + low[hit]
    part, text, at = block.item[entry], text[hit], at[hit]
    order = np.lexsort((at, part, text))
    part, text, at, own = part[order], text[order], at[order], block.place[entry][order]
    reach = 3 * block.sizes - np.floor(block.limits(least)).astype("i8")
    new = (np.diff(text, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0) | (np.diff(at, prepend=0) > reach[part])
    run = np.cumsum(new) - 1
    edges = np.flatnonzero(np.append(new, True))
    longest = int(block.sizes.max()) if len(block.sizes) else 1
    different = np.bincount(np.unique(run * longest + own) // longest, minlength=len(edges) - 1)
    enough = np.minimum(block.fewest(least), _HITS)
    for k in np.flatnonzero(different >= enough[part[edges[:-1]]]):
        a, b = edges[k], edges[k + 1] - 1
        yield int(text[a]), int(part[a]), int(at[a]), int(at[b])


def _stretches(words: np.ndarray, own: np.ndarray, width: int, reach: int, fewest: int) -> Iterator[tuple[int, int]]:
    """Where so many seeds of a part stand within reach of each other as a copy has, begin and end."""
    marked = np.zeros(len(words), bool)
    for k in range(1, min(width, len(words))):
        seeds = _seeds(words, k)
        marked[:len(seeds)] |= own[np.minimum(np.searchsorted(own, seeds), len(own) - 1)] == seeds
    at = np.flatnonzero(marked)
    if len(at) < fewest:
        return
    dense = np.flatnonzero(at[fewest - 1:] - at[:len(at) - fewest + 1] < reach)
    if not len(dense):
        return
    # Each of these begins a dense run of marks, from itself to the last one within reach.
    begin, end = at[dense], at[np.searchsorted(at, at[dense] + reach) - 1]
    cut = np.flatnonzero(begin[1:] > end[:-1]) + 1
    for a, b in zip([0, *cut], [*cut, len(begin)]):
        yield int(begin[a]), min(int(end[b - 1]) + width, len(words))


def _copies(
    words: np.ndarray, starts: np.ndarray, text: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, block: Block, least: float
) -> Iterator[tuple[int, int, float, int, int]]:
    """The same of the texts that have hits at the words ``at``, each of the block's n-grams from ``low`` to ``high``."""
    limits, fewest = block.limits(least), block.fewest(least)
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    long: dict[tuple[int, int], tuple[int, int]] = {}

    def found(t: int, i: int, known: np.ndarray, begin: int, stop: int, limit: float) -> None:
        score, end = align(known, words[begin:stop])
        similarity = score / (2 * len(known))
        if score >= limit and similarity > best.get((t, i), (0.0,))[0]:
            back = align(known[::-1], words[begin:begin + end][::-1])[1]
            best[t, i] = similarity, begin + end - back - int(starts[t]), begin + end - int(starts[t])

    for t, p, first, last in _candidates(text, at, low, high, block, least):
        known, i, limit = block.parts[p], int(block.owner[p]), limits[p]
        reach = 3 * len(known) - int(limit)
        begin, stop = max(int(starts[t]), first - reach), min(int(starts[t + 1]), last + reach + block.width)
        for a, b in _stretches(words[begin:stop], block.own[p], block.width, reach, int(fewest[p])):
            if len(known) == len(block.words[i]):
                found(t, i, known, begin + a, begin + b, limit)
            elif align(known, words[begin + a:begin + b])[0] >= limit:
                before = long.get((t, i), (begin + a, begin + b))
                long[t, i] = min(before[0], begin + a), max(before[1], begin + b)
    # Of a long item the whole is aligned, around its parts.
    for (t, i), (a, b) in long.items():
        whole = block.words[i]
        found(t, i, whole, max(int(starts[t]), a - 3 * len(whole)), min(int(starts[t + 1]), b + 3 * len(whole)), 2 * PASSAGE)
    for (t, i), (similarity, start, end) in best.items():
        yield t, i, similarity, start, end


def _seeded(docs: DataFrame, benchmark: DataFrame, width: int, least: float, block_grams: int) -> Iterator[Block]:
    if width < 3:
        raise ValueError("seeds must reach over three words or more")
    for block in blocks_of(benchmark, width, block_grams):
        yield block.rare(frequencies(docs, block), least)


def find(docs: DataFrame, benchmark: DataFrame, width: int = 3, least: float = 0.5, block_grams: int = 2_000_000) -> DataFrame:
    """Copies of test items in the texts: doc_id, item_id, similarity, start, end, item_words.

    One row for each text and item it has a copy of, the best one. ``similarity`` is the share
    of the full alignment score of the item, 1 for an exact copy; copies below ``least`` count
    only if their score is that of ``PASSAGE`` unchanged words or more. Of an item of more than
    ``PART`` words one of its parts must have that score; of a short item a copy has the score of
    ``FEWEST`` unchanged words, or of all it has. Words are compared in lower case
    without ASCII signs; start and end count such words. A pair of words of the item that
    stands in the text with up to ``width - 2`` words between them is a seed.

    Null and empty texts and items have no words and match nothing, nor do items shorter than
    ``width`` words. Null ids come back as they are, repeated rows of texts each, of items once.
    Other columns are ignored; without items or texts there are no rows.
    """
    out = docs.sparkSession.createDataFrame([], FOUND)
    for block in _seeded(docs, benchmark, width, least, block_grams):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, sieve = shared.value, shared.value.sieve()
            for ids, texts in text_groups(batches, _TASK_BYTES, plain):
                rows = [
                    (ids[t], own.ids[i], similarity, start, end, len(own.words[i]))
                    for t, i, similarity, start, end in matches(texts, own, sieve, least)
                ]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                    ["doc_id", "item_id", "similarity", "start", "end", "item_words"],
                )

        out = out.union(bare(docs).mapInArrow(run, FOUND))
    return out


def remove(docs: DataFrame, benchmark: DataFrame, width: int = 3, least: float = 0.5, block_grams: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` without a copy of a test item, as ``find`` would find it."""
    out = docs
    for block in _seeded(docs, benchmark, width, least, block_grams):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def judge(texts: list[str], shared=shared) -> list[bool]:
            own, sieve = shared.value, shared.value.sieve()
            keep, at = [True] * len(texts), 0
            for part in _parts([plain(x) for x in texts]):
                for t, *_ in matches(part, own, sieve, least):
                    keep[at + t] = False
                at += len(part)
            return keep

        out = keep_rows(out, judge)
    return out


def _parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size > _TASK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held
