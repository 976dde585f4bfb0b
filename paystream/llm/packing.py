"""Cost-balanced packing of tokenized documents into sequences of a fixed length."""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystream.llm.common import BLANKS, Remembered, parts, texts_of

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, sequence_length long, sequence_cost double"
)
_MOST_WORDS = 200_000
#: Small Latin letters beyond ASCII: each is its own small form, and composed.
_LATIN = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_PLAIN = re.compile(rf"[\x21-\x7E{_LATIN}]+")
_SAFE = re.compile(r"[\x00-\xFF]*")
_ENCODERS: dict[str, "_Encoder"] = {}


class _Encoder:
    """Ids of a text as little-endian 32-bit bytes, by way of a bounded memory of pieces.

    The tokenizer drops blanks and never merges across them, so the ids of a text are those of
    its words, one after the other, and those of a word are the ids of the pieces that the
    tokenizer's own normalizer and pre-tokenizer make of it. Words of printable ASCII and Latin
    letters are taken apart by its pattern in their stead, all words of a text in one go, if that
    gives the same for samples of all kinds. Any other word is a piece in this sense.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.normalize = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.tokenize = self.tokenizer.model.tokenize
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Latin letters as the pre-tokenizer writes them, byte by byte.
        self.written = {ord(c): "".join(p for p, _ in self.split(c)) for c in _LATIN}
        self.find = self._pattern(path)
        self.piece = Remembered(self._piece, _MOST_WORDS)

    def _pattern(self, path: str):
        """What finds the pieces of a text in lower case; None if nothing does."""
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)["pre_tokenizer"].get("pretokenizers", [])
        if not steps or steps[0]["type"] != "Split" or "Regex" not in steps[0]["pattern"]:
            return None
        letters = f"a-z{_LATIN}"
        own = steps[0]["pattern"]["Regex"].replace(r"[\p{L}]", r"\p{L}").replace(r"\p{L}+", f"[{letters}]+")
        own = own.replace(r"\p{L}", letters).replace(r"[\p{N}]", "[0-9]").replace(r"\p{N}", "0-9")
        signs = [chr(c) for c in range(0x21, 0x7F)] + list(_LATIN)
        samples = [a + b for a in signs for b in signs[::7]] + ["it's", "I'LL'd", "'RE12ab", "aB..c3", "--x--'t", "Éa1ç,É"]
        try:
            pieces = re.compile(own).findall
        except re.error:
            return None
        for x in samples:
            if [p.translate(self.written) for p in pieces(x.lower())] != [p for p, _ in self.split(self.normalize(x))]:
                return None
        plain, other = rf"\x21-\x7E{letters}", rf"^\x21-\x7E{letters}{BLANKS}"
        word = rf"(?<![^{BLANKS}])[{plain}]*+[{other}][^{BLANKS}]*"
        return re.compile(f"{word}|{own}").findall

    def _ids(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.tokenize(piece)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        if _PLAIN.fullmatch(piece):
            return self._ids(piece.translate(self.written))
        return b"".join([self._ids(p) for p, _ in self.split(self.normalize(piece))])

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if self.find is None or any(x in text for x in self.added):
                yield b"".join([self._plain(x.decode()) for x in text.encode().split()])
            else:
                # Only where no letter's small form depends on others is a whole text changed at once.
                lower = text.lower() if _SAFE.fullmatch(text) else text.encode().lower().decode()
                yield b"".join(map(self.piece.__getitem__, self.find(lower)))


def _encoder(path: str) -> _Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def sequence_lengths(tokens: int, capacity: int) -> list[int]:
    """Lengths that hold exactly ``tokens``: full sequences, then distinct powers of two.

    A sequence whose length is a power of two needs no padding, so nothing is padded at all.
    """
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def assign(
    lengths: list[int], capacity: int, linear: float, quadratic: float, longest: int | None = None
) -> list[list[tuple[int, int, int]]]:
    """Cut and place documents; returns for each sequence its pieces (document, start, length).

    The costliest open piece goes to the sequence that has cost least so far and has room. What
    does not fit there is cut off and waits its turn as a piece of its own. Attention is paid
    within a piece, so a piece costs ``linear * n + quadratic * n * n``. Pieces are at most
    ``longest`` tokens (half a sequence unless given), else sequences of one piece would cost
    more than any mix can.
    """
    longest = longest or max(1, capacity // 2)
    sizes = sequence_lengths(sum(lengths), capacity)
    placed: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    open_sequences = [(0.0, k, size) for k, size in enumerate(sizes)]
    pieces = [(-n, d, 0) for d, n in enumerate(lengths) if n]
    heapq.heapify(pieces)
    while pieces:
        negative, doc, start = heapq.heappop(pieces)
        cost, k, room = open_sequences[0]
        n = min(-negative, room, longest)
        placed[k].append((doc, start, n))
        if room > n:
            heapq.heapreplace(open_sequences, (cost + linear * n + quadratic * n * n, k, room - n))
        else:
            heapq.heappop(open_sequences)
        if n < -negative:
            heapq.heappush(pieces, (negative + n, doc, start + n))
    return placed


def _pack(docs: list[tuple], first: int, capacity: int, linear: float, quadratic: float) -> pa.RecordBatch:
    lengths = [len(ids) // 4 for _, ids in docs]
    columns: list[list] = [[] for _ in range(9)]
    for k, pieces in enumerate(assign(lengths, capacity, linear, quadratic)):
        total = sum(n for _, _, n in pieces)
        cost = sum(linear * n + quadratic * n * n for _, _, n in pieces)
        offset = 0
        for doc, start, n in pieces:
            doc_id, ids = docs[doc]
            crc = zlib.crc32(memoryview(ids)[4 * start:4 * (start + n)])
            row = (doc_id, start, n, crc, lengths[doc], first + k, offset, total, cost)
            for column, value in zip(columns, row):
                column.append(value)
            offset += n
    names = [x.split()[0] for x in PIECES.split(", ")]
    kinds = [pa.int64()] * 8 + [pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2,
    linear: float = 1.0, quadratic: float = 1 / 2048, chunk_tokens: int = 2_000_000,
) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens, one row per piece.

    A document is the ids of its text followed by ``end_id``. Each task packs its documents in
    chunks of about ``chunk_tokens`` tokens, which bounds its memory; nothing is shuffled.
    ``sequence_id`` is the task's number and a counter within it.

    Null text counts as empty (one token, the end id), a null id stays null, repeated rows are
    packed each, an empty table gives no rows, and other columns are ignored. A document longer
    than a chunk is packed whole in a chunk of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        held: list[tuple] = []
        tokens = 0
        for batch in parts(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch))):
                held.append((doc_id, ids + end))
                tokens += len(ids) // 4 + 1
                if tokens >= chunk_tokens:
                    yield _pack(held, sequence, capacity, linear, quadratic)
                    sequence += len(sequence_lengths(tokens, capacity))
                    held, tokens = [], 0
        if held:
            yield _pack(held, sequence, capacity, linear, quadratic)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)
