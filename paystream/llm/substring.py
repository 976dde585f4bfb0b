"""Substring deduplication: suffixes in prefix-partitioned subtrees, deep nodes as repeats.

A suffix starts at each word that has a window of ``window`` words behind it. Suffixes are dealt
out by a prefix of variable length: one word where few suffixes begin with it, more where many
do, the whole window in the end, so that a group is a set of subtrees of the suffix tree that
fits in memory. In a group, suffixes are ordered by the hash of their path to the depth of a
window; those on the same path lie below one internal node of at least that depth, and the node
is a repeat. A repeat is left in the document with the least id and found in all others.
Overlapping and touching windows of a document make up its maximal repeats.

Only paths are moved, not texts: a suffix is 8 bytes of path hash (within its group, which is
fixed by an independent hash of the prefix) and about two bytes for its place. Suffixes of the
same path from one task are settled there, so that a passage in very many documents sends one
suffix from each task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystream.llm.common import parts, text_groups
from paystream.llm.hashing import mix, run_hashes, word_hashes

#: Prefix lengths that are counted; past them the whole window is the prefix.
DEPTHS = (1, 2, 4)
_BINS = 4096
#: An id above all others, for documents without one: their windows count as repeats of any other.
_NO_ID = (1 << 63) - 1
#: Bytes of text a task works on at once.
_TASK_BYTES = 4_000_000


def _bin(prefix: np.ndarray, depth: int) -> np.ndarray:
    return (mix(prefix + np.uint64(depth)) % np.uint64(_BINS)).astype("i8")


def _paths(texts: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """All words; then document, place, number of the first word and path of each suffix."""
    words, starts = word_hashes(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(starts))
    place = np.arange(len(words)) - starts[doc]
    first = np.flatnonzero(place + window <= np.diff(starts)[doc])
    return words, doc[first], place[first], first, run_hashes(words, window)[first]


def prefix_counts(docs: DataFrame, window: int, task_bytes: int = _TASK_BYTES) -> np.ndarray:
    """How many suffixes begin with a prefix of each length, by hash of the prefix, over all texts.

    The table has a fixed size, whatever the input; each task sends one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(DEPTHS), _BINS), "i8")
        for _, texts in text_groups(batches, task_bytes):
            words, _, _, first, _ = _paths(texts, window)
            for k, depth in enumerate(DEPTHS):
                if depth < window and len(first):
                    seen[k] += np.bincount(_bin(run_hashes(words, depth)[first], depth), minlength=_BINS)
        slot = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype("i4")), pa.array(seen.ravel()[slot])], ["slot", "n"])

    total = np.zeros(len(DEPTHS) * _BINS, "i8")
    for r in docs.mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        total[r["slot"]] = r["n"]
    return total.reshape(len(DEPTHS), _BINS)


def _group_of(words: np.ndarray, first: np.ndarray, paths: np.ndarray, counts: np.ndarray, quota: int, groups: int) -> np.ndarray:
    """Group of each suffix: by its shortest prefix that few enough suffixes share."""
    group = (mix(paths ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(groups)).astype("i8")
    todo = np.ones(len(first), bool)
    for k, depth in enumerate(DEPTHS):
        if not counts[k].any():  # not shorter than a window
            continue
        prefix = run_hashes(words, depth)[first]
        fits = todo & (counts[k][_bin(prefix, depth)] <= quota)
        group[fits] = (mix(prefix[fits] ^ np.uint64(0x14057B7EF767814F)) % np.uint64(groups)).astype("i8")
        todo &= ~fits
    return group


def _tags(texts: list[bytes]) -> np.ndarray:
    """64-bit hashes of texts; with the id, they name a row."""
    return np.array([int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little") for x in texts], "u8")


def _pack(ids: np.ndarray, tags: np.ndarray, doc: np.ndarray, place: np.ndarray, press) -> bytes:
    """Places by document, as compressed counts, differences of ids, tags and places."""
    edge = np.flatnonzero(np.diff(doc, prepend=-1))
    rows = doc[edge]
    counts = np.diff(edge, append=len(doc)).astype("<i4")
    gaps = np.diff(place, prepend=0)
    gaps[edge] = place[edge]
    parts = [
        np.diff(ids[rows], prepend=0).astype("<i8").tobytes(), tags[rows].astype("<u8").tobytes(),
        counts.tobytes(), gaps.astype("<i4").tobytes(),
    ]
    planes = [np.frombuffer(x, "u1").reshape(-1, w).T.tobytes() for x, w in zip(parts, (8, 8, 4, 4))]
    return len(rows).to_bytes(4, "little") + press.compress(b"".join(planes))


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and tags of documents, then document and place of each entry."""
    n = int.from_bytes(data[:4], "little")
    plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[4:]), "u1")
    ends = np.cumsum([8 * n, 8 * n, 4 * n])
    ids, tags, counts, gaps = (
        np.ascontiguousarray(x.reshape(w, -1).T).view(kind).ravel()
        for x, w, kind in zip(np.split(plain, ends), (8, 8, 4, 4), ("<i8", "<u8", "<i4", "<i4"))
    )
    doc = np.repeat(np.arange(n), counts)
    total = np.cumsum(gaps, dtype="i8")
    first = np.cumsum(counts) - counts
    before = np.where(first > 0, total[first - 1], 0) if n else total
    return np.cumsum(ids), tags, doc, total - before[doc]


def _later(paths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of each suffix, whether another with its path is of a document with a smaller id."""
    order = np.lexsort((ids, paths))
    node = np.diff(paths[order], prepend=~paths[order[:1]]) != 0
    first = np.flatnonzero(node)
    least = ids[order][first][np.cumsum(node) - 1]
    later = np.zeros(len(paths), bool)
    later[order] = ids[order] > least
    return later


def _block_of(ids: np.ndarray, tags: np.ndarray, blocks: int) -> np.ndarray:
    return (mix(mix(ids.view("u8") + np.uint64(1)) ^ tags) % np.uint64(blocks)).astype("i8")


def _by_block(ids, tags, doc, place, blocks: int, press) -> Iterator[tuple[int, bytes]]:
    """Places packed apart for each block of documents."""
    block = _block_of(ids, tags, blocks)[doc]
    order = np.argsort(block, kind="stable")
    edges = np.flatnonzero(np.diff(block[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)]):
        part = order[a:b]
        yield int(block[part[0]]), _pack(ids, tags, doc[part], place[part], press)


def suffixes(
    docs: DataFrame, window: int, counts: np.ndarray, quota: int, groups: int, blocks: int, task_bytes: int = _TASK_BYTES
) -> DataFrame:
    """Suffixes of all texts by group: grp, block, paths, places.

    Rows with a block are repeats already: another document of the same task has the path and a
    smaller id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(1)
        for ids, texts in text_groups(batches, task_bytes):
            names = np.array([_NO_ID if x is None else x for x in ids], "i8")
            tags = _tags(texts)
            words, doc, place, first, paths = _paths(texts, window)
            if not len(first):
                continue
            later = _later(paths, names[doc])
            group = _group_of(words, first, paths, counts, quota, groups)
            out = [
                (block % groups, block, b"", packed)
                for block, packed in _by_block(names, tags, doc[later], place[later], blocks, press)
            ]
            rest = np.flatnonzero(~later)
            order = rest[np.argsort(group[rest], kind="stable")]
            edges = np.flatnonzero(np.diff(group[order], prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(order)]):
                part = order[a:b]
                out.append((int(group[part[0]]), -1, paths[part].tobytes(), _pack(names, tags, doc[part], place[part], press)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                ["grp", "block", "paths", "places"],
            )

    return docs.mapInArrow(run, "grp long, block long, paths binary, places binary")


def repeats(suffix_rows: DataFrame, blocks: int) -> DataFrame:
    """Places of repeats by block of documents, from the subtrees of each group."""

    def run(rows: pa.Table) -> pa.Table:
        press = zstandard.ZstdCompressor(1)
        out, paths, ids, tags, doc, place, n = [], [], [], [], [], [], 0
        for block, path, places in zip(rows.column("block").to_pylist(), rows.column("paths"), rows.column("places")):
            if block >= 0:
                out.append((block, places.as_py()))
                continue
            own_ids, own_tags, own_doc, own_place = _unpack(places.as_py())
            paths.append(np.frombuffer(path.as_buffer(), "<u8"))
            ids.append(own_ids)
            tags.append(own_tags)
            doc.append(own_doc + n)
            place.append(own_place)
            n += len(own_ids)
        if paths:
            all_ids, all_tags, all_doc = np.concatenate(ids), np.concatenate(tags), np.concatenate(doc)
            later = _later(np.concatenate(paths), all_ids[all_doc])
            out += _by_block(all_ids, all_tags, all_doc[later], np.concatenate(place)[later], blocks, press)
        return pa.table([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["block", "places"])

    return suffix_rows.groupBy("grp").applyInArrow(run, "block long, places binary")


def _cut(text: bytes, removed: np.ndarray) -> bytes:
    """The text without the removed words and the blanks that follow each."""
    parts = re.split(rb"([\x20\x09-\x0D]+)", text.lstrip(b" \t\n\x0b\x0c\r"))
    kept = [b"".join(parts[2 * k:2 * k + 2]) for k in np.flatnonzero(~removed)]
    return b"".join(kept).rstrip(b" \t\n\x0b\x0c\r")


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>, text string"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _blocks_of(docs: DataFrame, window: int, blocks: int) -> DataFrame:
    """Compressed texts by block, with their hash and the columns to carry; null text is null.

    Texts without a window have no repeats and go to any block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, turn = zstandard.ZstdCompressor(3), 0
        for batch in parts(batches):
            ids = np.array([_NO_ID if x is None else x for x in batch.column("doc_id").to_pylist()], "i8")
            texts = [None if x is None else x.encode() for x in batch.column("text").to_pylist()]
            packed = [None if x is None else press.compress(x) for x in texts]
            tags = _tags([x or b"" for x in texts])
            # A window has a byte for each word and a blank between them at least.
            short = np.array([len(x or b"") < 2 * window - 1 for x in texts], bool)
            block = np.where(short, (turn + np.arange(len(texts))) % blocks, _block_of(ids, tags, blocks))
            turn += len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(tags.view("i8")), *batch.columns[2:]],
                ["block", "doc_id", "body", "tag", *batch.schema.names[2:]],
            )

    schema = T.StructType().add("block", "long").add("doc_id", "long").add("body", "binary").add("tag", "long")
    return docs.mapInArrow(run, T.StructType([*schema.fields, *docs.schema.fields[2:]]))


def deduplicate(
    docs: DataFrame, window: int = 13, group_suffixes: int = 1_000_000, block_words: int = 2_000_000, with_text: bool = True,
    carry: tuple[str, ...] = (), task_bytes: int = _TASK_BYTES,
) -> DataFrame:
    """Remove the words of every run of ``window`` words that also starts in a document with a smaller id.

    Runs are judged on the input. Gives doc_id, n_words, n_removed, kept_sha256 (of the words
    that stay, joined by single spaces), spans (the maximal repeats taken out, in words, end not
    included) and, if ``with_text``, text: as it was where nothing was removed, else without the
    repeats and the blanks after them.

    Null text has no words and stays null, empty text stays empty. A null id is above all
    others and takes nothing from other null ids. Rows that repeat an id are documents of their
    own that take nothing from each other (they are told apart by a 64-bit hash of the text, and
    rows of equal id and text have equal results). An empty table gives no rows. The columns to ``carry`` come along unchanged, other
    ones are ignored. A worker takes ``task_bytes`` of text at a time, at some 60 bytes of memory for each.
    """
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    own = bare.select("doc_id", "text")
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = prefix_counts(own, window, task_bytes)
    total = int(counts[0].sum())
    groups, blocks = max(least, -(-total // group_suffixes)), max(least, -(-total // block_words))
    found = repeats(suffixes(own, window, counts, group_suffixes // 4, groups, blocks, task_bytes), blocks)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        places: dict[tuple[int, int], list[np.ndarray]] = {}
        for packed in right.column("places"):
            ids, tags, doc, place = _unpack(packed.as_py())
            edges = np.flatnonzero(np.diff(doc, prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(doc)]):
                k = doc[a]
                places.setdefault((int(ids[k]), int(tags[k])), []).append(place[a:b])
        out: list[tuple] = []
        unpress = zstandard.ZstdDecompressor()
        for doc_id, body, tag in zip(left.column("doc_id").to_pylist(), left.column("body"), left.column("tag").to_numpy().view("u8")):
            text = unpress.decompress(body.as_py()) if body.is_valid else b""
            words = text.split()
            own = places.get((_NO_ID if doc_id is None else doc_id, int(tag)))
            spans, removed = [], None
            if own:
                at = np.concatenate(own)
                steps = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + window, minlength=len(words) + 1)
                removed = np.cumsum(steps)[:len(words)] > 0
                turns = np.flatnonzero(np.diff(removed.view("i1"), prepend=0, append=0)).reshape(-1, 2)
                spans = [{"start": int(a), "end": int(b)} for a, b in turns]
                words = [words[k] for k in np.flatnonzero(~removed)]
            n_removed = int(removed.sum()) if own else 0
            kept = None
            if with_text and body.is_valid:
                kept = (_cut(text, removed) if own else text).decode()
            digest = hashlib.sha256(b" ".join(words)).hexdigest()
            out.append((doc_id, len(words) + n_removed, n_removed, digest, spans, kept))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), _SPANS, pa.string())
        columns = [pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)]
        return pa.table([*columns, *left.columns[4:]], [*names, *left.column_names[4:]])

    schema = T.StructType([*spark.createDataFrame([], _RESULT).schema.fields, *bare.schema.fields[2:]])
    names = schema.names[:6]
    return _blocks_of(bare, window, blocks).groupBy("block").cogroup(found.groupBy("block")).applyInArrow(run, schema)
