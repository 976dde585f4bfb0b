"""Documents rearranged for learning to fill in the middle, and put back into order."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystream.llm.common import parts

#: What stands before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
REARRANGED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

# Bytes of UTF-8: a run of letters, or one other character, whatever its length. 0xFF stands in
# no text, so it can part the units.
_UNIT = rb"([A-Za-z]+|[\x00-\x7F]|[\xC0-\xF7][\x80-\xBF]*)"
_PARTED = rb"\1" + b"\xff"
_SLICE = 500_000


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2 ** 32 for each id, from a digest of the seed and the id.

    A null id counts as empty text.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _units(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Number of units of each text, all units in one array, and each one's text and ordinal."""
    lists = pc.split_pattern(pc.replace_substring_regex(texts.cast(pa.binary()), pattern=_UNIT, replacement=_PARTED), pattern=b"\xff")
    # Each unit ends in a separator, so there is one empty string too many at the end of a list.
    lengths = pc.list_value_length(lists).to_numpy().astype("i8")
    parent = pc.list_parent_indices(lists).to_numpy()
    ordinal = np.arange(len(parent)) - (np.cumsum(lengths) - lengths)[parent]
    return lengths - 1, pc.list_flatten(lists), parent, ordinal


def _joined(units: pa.Array, chosen: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The chosen units, ``lengths`` of them for each text, as one string per text."""
    ends = np.zeros(len(lengths) + 1, "i4")
    np.cumsum(lengths, out=ends[1:])
    lists = pa.ListArray.from_arrays(pa.array(ends), units.filter(pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar(b"", pa.binary())).cast(pa.string())


def _concat(*pieces: pa.Array | str) -> pa.Array:
    return pc.binary_join_element_wise(*pieces, "")


def _rearrange(batch: pa.RecordBatch, plain_percent: int, suffix_first_percent: int, markers: tuple[str, str, str]) -> pa.RecordBatch:
    p, s, m = markers
    texts = pc.fill_null(batch.column("text"), "")
    h1, h2, h3, h4 = (batch.column(f"h{k}").to_numpy() for k in range(1, 5))
    n, units, parent, ordinal = _units(texts)
    cuts = h1 % (n + 1), h2 % (n + 1)
    first, second = np.minimum(*cuts), np.maximum(*cuts)
    a, b, end = first[parent], second[parent], n[parent]
    prefix = _joined(units, ordinal < a, first)
    middle = _joined(units, (ordinal >= a) & (ordinal < b), second - first)
    suffix = _joined(units, (ordinal >= b) & (ordinal < end), n - second)
    marked = np.zeros(len(n), bool)
    for marker in markers:
        marked |= pc.match_substring(texts, marker).to_numpy(zero_copy_only=False)
    plain = pa.array(marked | (n == 0) | (h3 % 100 >= 100 - plain_percent))
    suffix_first = pa.array(h4 % 100 < suffix_first_percent)
    form = pc.if_else(plain, "plain", pc.if_else(suffix_first, "spm", "psm"))
    output = pc.if_else(plain, texts, pc.if_else(
        suffix_first, _concat(s, suffix, p, prefix, m, middle), _concat(p, prefix, s, suffix, m, middle),
    ))
    chars = (pc.if_else(plain, None, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(n), form, *chars, output],
        ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain_percent: int = 10, suffix_first_percent: int = 20,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """Every document cut in three and put together with the middle last: REARRANGED.

    Units are runs of A-Z and a-z, and single other characters; ``n`` is their number. The
    digest of ``seed`` and the id gives both cuts (which may be equal, and lie at the ends) and
    the form: ``plain`` is the text as it is, for about ``plain_percent`` of documents and all
    that are empty or contain a marker; ``spm`` has the suffix first, for about
    ``suffix_first_percent`` of the others; the rest is ``psm``. Lengths of prefix and middle are
    in code points, and null for plain ones.

    Batches are cut into slices of 0.5 MB of text or one longer text, whose units take about 40
    bytes each while they are worked on. A null text counts as empty and a null id as empty text
    in the digest; repeated rows come out alike, once each; an empty table gives no rows; other
    columns are ignored. There are no ties.
    """

    if not all(re.fullmatch("<[A-Za-z]+>", x) for x in markers) or len(set(markers)) != 3:
        raise ValueError("markers are three different words of letters in <>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, most_bytes=_SLICE):
            yield _rearrange(batch, plain_percent, suffix_first_percent, markers)

    h = draws(F.col("doc_id"), seed)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        *(x.alias(f"h{k}") for k, x in enumerate(h, 1)),
    ).mapInArrow(run, REARRANGED)


def _restore(batch: pa.RecordBatch, markers: tuple[str, str, str]) -> pa.RecordBatch:
    form, output = batch.column("form"), batch.column("output")
    restored = output
    for name, at in (("psm", (1, 3, 2)), ("spm", (2, 3, 1))):
        chosen = pc.equal(form, name)
        pieces = pc.split_pattern_regex(output.filter(chosen), pattern="|".join(markers))
        text = _concat(*(pc.list_element(pieces, k) for k in at))
        restored = pc.replace_with_mask(restored, chosen, text)
    return batch.append_column("restored", restored)


def restore(rearranged: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """The rows of ``fill_in_middle`` with the text again (``restored``), from form and output.

    Only plain texts contain markers of their own, so the others part at theirs: a marker starts
    with ``<``, ends with ``>`` and has letters between, so none arises where one meets a piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "output", _SLICE):
            yield _restore(batch, markers)

    columns = rearranged.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    return columns.mapInArrow(run, REARRANGED + ", restored string")
