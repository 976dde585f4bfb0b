"""URL filter: a memory-mapped sorted array of 64-bit digests, probed by binary search."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystream.llm.common import lower_ascii
from paystream.session import work_dir

RULE_SCHEMA = "host string, path string, verdict string, own boolean"
_MAPPED: dict[str, "_Block"] = {}


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class _Block:
    """One file of the index: the count, digests, ends of the strings, flags, strings."""

    def __init__(self, path: str) -> None:
        n = int(np.fromfile(path, "<i8", 1)[0])
        self.digests = np.memmap(path, "<i8", "r", 8, n)
        self.ends = np.memmap(path, "<i8", "r", 8 + 8 * n, n)
        self.flags = np.memmap(path, "u1", "r", 8 + 16 * n, n)
        self.strings = np.memmap(path, "u1", "r", 8 + 17 * n)

    def probe(self, digests: np.ndarray, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the keys that the block holds, and their flags."""
        first = np.searchsorted(self.digests, digests, "left")
        found, flags = [], []
        inside = np.flatnonzero(first < len(self.digests))
        for k in inside[self.digests[first[inside]] == digests[inside]]:
            want = keys[k].as_py().encode()
            at = int(first[k])
            while at < len(self.digests) and self.digests[at] == digests[k]:  # equal digests lie together
                start = int(self.ends[at - 1]) if at else 0
                if self.strings[start:int(self.ends[at])].tobytes() == want:
                    found.append(k)
                    flags.append(int(self.flags[at]))
                at += 1
        return np.array(found, "i8"), np.array(flags, "u1")


def _block(name: str) -> _Block:
    """The arrays of a fetched file, which the first worker of an executor writes beside it."""
    if name not in _MAPPED:
        fetched = SparkFiles.get(name)
        mapped = f"{fetched}.idx"
        if not os.path.exists(mapped):
            rows = pq.read_table(fetched, columns=["digest", "key", "flags"], partitioning=None)
            keys = rows["key"].cast(pa.binary()).to_pylist()
            # In place at once, as other workers may be doing the same.
            os.replace(_write(list(zip(rows["digest"].to_pylist(), keys, rows["flags"].to_pylist())), os.path.dirname(fetched)), mapped)
        _MAPPED[name] = _Block(mapped)
    return _MAPPED[name]


@dataclass(frozen=True)
class UrlIndex:
    """Names of the files each executor fetches once, lengths of the rules' paths, labels of their hosts."""

    files: tuple[str, ...]
    path_lengths: tuple[int, ...]
    labels: tuple[int, ...]


def _write(rows: list[tuple[int, bytes, int]], folder: str) -> str:
    path = os.path.join(folder, f"urls-{uuid.uuid4().hex}.idx")
    with open(path, "wb") as out:
        np.array([len(rows)] + [r[0] for r in rows], "<i8").tofile(out)
        np.cumsum([len(r[1]) for r in rows]).astype("<i8").tofile(out)
        np.array([r[2] for r in rows], "u1").tofile(out)
        # One spare byte, as an empty file section can't be mapped.
        out.write(b"".join(r[1] for r in rows) + b"\0")
    return path


def build_index(rules: DataFrame, block_keys: int = 500_000) -> UrlIndex:
    """Write the sorted digest array of ``rules`` (host, path, verdict, own) and hand it out.

    Tasks sort the rules by digest range and write them below the shared work folder, at most
    ``block_keys`` to a file; executors fetch the files and map the arrays made of them, so no
    rule passes through the driver, which sees names of files, lengths of paths and numbers of
    labels. ``own`` rules are those that give a row its rule; the others only decide where no own
    rule fits. Rules with a null or empty host are left out; of equal rules with both verdicts,
    ``block`` counts.
    """
    spark = rules.sparkSession
    keyed = (
        rules.where("host is not null and host <> ''")
        .select(lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict", "own")
        .groupBy("host", "path", "own")
        .agg(F.max(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("blocks"))
        .select(
            F.concat("host", "path").alias("key"), F.length("path").alias("path_length"), _labels(F.col("host")).alias("labels"),
            (F.col("blocks") + F.when(F.col("own"), 2).otherwise(0)).alias("flags"),
        )
        .select(F.xxhash64("key").alias("digest"), "key", "flags", "path_length", "labels")
    )
    path = work_dir(spark, "urls")
    order = ["digest", "key", "flags"]
    keyed.repartitionByRange("digest").sortWithinPartitions(*order).write.option("maxRecordsPerFile", block_keys).parquet(path)
    stored = spark.read.schema(keyed.schema).parquet(path)
    files = sorted(r[0] for r in stored.select("_metadata.file_path").distinct().collect())
    for file in files:
        spark.sparkContext.addFile(file)
    seen = stored.agg(F.collect_set("path_length"), F.collect_set("labels")).first()
    return UrlIndex(tuple(f.rsplit("/", 1)[1] for f in files), tuple(sorted(seen[0])), tuple(sorted(seen[1])))


def _labels(host: Column) -> Column:
    """The number of labels of a host, dots and one."""
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _candidates(host: Column, path: Column, index: UrlIndex) -> Column:
    """The domains the host lies in, joined with the starts of the path, as many as a rule may have.

    Domains are taken from the right, so a host costs its length once for each number of labels
    that any rule has, however many labels it has itself.
    """
    labels = _labels(host)
    domains = F.array_compact(F.array(*[F.when(labels >= n, F.substring_index(host, ".", -n)) for n in index.labels or (1,)]))
    starts = F.array_compact(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in index.path_lengths or (0,)]))
    each = F.flatten(F.transform(domains, lambda d: F.transform(starts, lambda s: F.concat(d, s))))
    return F.when(host != "", each).otherwise(F.array().cast("array<string>"))


def judge(urls: DataFrame, index: UrlIndex, id_col: str = "page_id", default: str = "allow") -> DataFrame:
    """Judge ``url`` of every row: page_id, host, path, rule, verdict, listed.

    Of the own rules that fit, the longest gives ``rule`` and ``verdict``; else the longest of
    the other listed rules gives the verdict (``listed`` is its text), else it is ``default``.
    A null url, or one without ``://``, has an empty host and path and gets ``default``.
    Repeated rows are judged each; other columns are ignored; without rules all get ``default``.
    """
    base = urls.select(F.col(id_col).cast("long").alias("page_id"), host_of(F.col("url").cast("string")).alias("host"), path_of(F.col("url").cast("string")).alias("path"))
    keyed = base.withColumn("keys", _candidates(F.col("host"), F.col("path"), index)).withColumn(
        "digests", F.transform("keys", lambda k: F.xxhash64(k))
    )
    files = index.files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("digests")
            row = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
            digests, keys = lists.flatten().to_numpy(zero_copy_only=False), batch.column("keys").flatten()
            rule: list[str | None] = [None] * len(batch)
            listed: list[str | None] = [None] * len(batch)
            verdict = [default] * len(batch)
            for name in files:
                for k, flags in zip(*_block(name).probe(digests, keys)):
                    held, at, key = (rule if flags & 2 else listed), row[k], keys[int(k)].as_py()
                    if held[at] is None or len(key) > len(held[at]):
                        held[at] = key
                        if flags & 2 or rule[at] is None:
                            verdict[at] = "block" if flags & 1 else "allow"
            columns = [batch.column("page_id"), batch.column("host"), batch.column("path")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(listed, pa.string())],
                ["page_id", "host", "path", "rule", "verdict", "listed"],
            )

    return keyed.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, listed string")
