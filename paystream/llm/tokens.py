"""Token counts of texts by byte-pair merging, without making token ids."""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystream.llm.common import Remembered, parts

COUNTS = "doc_id long, n_bytes long, n_tokens long"
#: Words, and pre-tokens, that a worker remembers.
_MOST = 150_000
_BLANKS = " \t\n\v\f\r"
_COUNTERS: dict[str, "Counter"] = {}


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many symbols are left when no adjacent pair of them has a rank.

    The symbols are a linked list, the pairs a heap by rank and place. The pair of the lowest
    rank, the leftmost of these, becomes one symbol; its new neighbours are pushed. A pair that
    was popped counts only if its two places still hold the symbols of that rank. Each merge
    takes one symbol away, so the count is the symbols at first less the merges.
    """
    n = len(symbols)
    symbols = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, i) for i, pair in enumerate(zip(symbols, symbols[1:])) if (rank := ranks.get(pair)) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if j >= n or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = ""  # no pair has an empty symbol, so what is left of this place in the heap is stale
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (found := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (found, i))
        h = before[i]
        if h >= 0 and (found := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (found, h))
    return n - merges


class Counter:
    """Counts the tokens of texts by the merges, normalizer and pre-tokenizer of a tokenizer's file.

    Only plain byte-pair encoding is known: files with an unknown token, byte fallback, dropout
    or prefixes of continued words are refused, as are added tokens that take blanks or are
    looked for after normalizing. Symbols outside of the vocabulary give no token.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        model, added = parsed["model"], parsed["added_tokens"]
        options = ("unk_token", "byte_fallback", "dropout", "continuing_subword_prefix", "ignore_merges")
        if model["type"] != "BPE" or any(model.get(x) for x in options):
            raise ValueError(f"{path} is not plain byte-pair encoding")
        if any(t[x] for t in added for x in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has added tokens that reach beyond their own characters")
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(merges)}
        self.vocabulary = frozenset(model["vocab"])
        self.suffix = model.get("end_of_word_suffix") or ""
        tokenizer = Tokenizer.from_file(path)
        self._normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self._pieces = tokenizer.pre_tokenizer.pre_tokenize_str
        longest_first = sorted((t["content"] for t in added), key=lambda x: (-len(x), x))
        self.added = re.compile("|".join(map(re.escape, longest_first))) if added else None
        self.of_piece = Remembered(self._piece, _MOST)
        self.of_word = Remembered(self._word, _MOST)
        self.blanks_part = self._blanks_part()

    def _blanks_part(self) -> bool:
        """Whether words between blanks have no say in each other's tokens; tried on a few."""
        samples = ["ab", "7", ",.", "é", "a's", "λ", "'"]
        split = lambda text: [x for x, _ in self._pieces(self._normalize(text))]
        return all(
            split(a + blank + b) == split(a) + split(b) and not split(blank)
            for blank in _BLANKS for a in samples for b in samples
        )

    def _piece(self, piece: str) -> int:
        symbols = [*piece[:-1], piece[-1] + self.suffix]
        return merged([s for s in symbols if s in self.vocabulary], self.ranks)

    def _plain(self, text: str) -> int:
        return sum(self.of_piece[piece] for piece, _ in self._pieces(self._normalize(text)))

    def _word(self, word: bytes) -> int:
        return self.whole(word.decode())

    def whole(self, text: str) -> int:
        """Tokens of a text taken in one go; an added token counts as one."""
        if self.added is None:
            return self._plain(text)
        between = self.added.split(text)
        return len(between) - 1 + sum(self._plain(x) for x in between if x)

    def count(self, text: bytes) -> int:
        """Tokens of a text in UTF-8."""
        if self.blanks_part:
            return sum(map(self.of_word.__getitem__, text.split()))
        return self.whole(text.decode())


def counter(path: str) -> Counter:
    """The counter of a file; a worker reads the file once."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Bytes and tokens of every whole text: doc_id, n_bytes, n_tokens.

    ``tokenizer`` is the path of a byte-pair vocabulary that the executors can read. Nothing is
    shuffled; a worker remembers a bounded number of words. Null and empty texts have no bytes
    and no tokens, a null id stays null, repeated rows are counted each, an empty table gives
    none, and other columns are ignored. A text without blanks is one word, and its merges take
    time by its length times the logarithm of that. No ties: pairs of equal rank merge from the left.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer).count
        for batch in parts(iter(batches)):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            counts = pa.array([count(x) if x else 0 for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), counts], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
    ).mapInArrow(run, COUNTS)
