"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import paystream

# The blanks between words: space, tab, line feed, vertical tab, form feed, carriage return.
# They are also what ``bytes.split()`` splits at.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: The package as a file that executors may fetch for as long as the session lives.
_PACKAGE: list[tempfile.TemporaryDirectory] = []


#: Bytes of an Arrow batch between Spark and Python; by default 10,000 rows go at once, however long.
_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``spark-submit --py-files`` would; once per session.

    Also bounds the Arrow batches of the session in bytes, unless it has a bound already.
    """
    context = spark.sparkContext
    if _BATCH[0] not in spark.conf.getAll:
        spark.conf.set(*_BATCH)
    if getattr(context, "_paystream_shipped", False):
        return
    if not _PACKAGE:
        _PACKAGE.append(tempfile.TemporaryDirectory(prefix="paystream-"))
    archive = Path(_PACKAGE[0].name) / f"paystream-{context.applicationId}.zip"
    root = Path(paystream.__file__).parent
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._paystream_shipped = True


def shipped(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``f(spark, ...)`` whose tasks can import this package."""

    @functools.wraps(f)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship(spark)
        return f(spark, *args)

    return run


class Remembered(dict):
    """Values of a function of texts: the shorter ones among the last ``most`` to ``2 * most`` asked for."""

    def __init__(self, f: Callable, most: int, longest: int = 64) -> None:
        self.f, self.most, self.longest = f, most, longest
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.f(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and nothing else changed."""
    return F.translate(text, UPPER, LOWER)


def word_array(text: Column) -> Column:
    """The words between blanks; an empty array for null or blank text."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(F.length(bare), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.split(bare, BLANK_RUN)
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row.

    A lambda that names an expression of the outside computes it again for each element; bound
    as a lambda variable it is a plain value.
    """
    return F.transform(F.array(value), body)[0]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of the id as text, mod 3, is 1.

    A null id counts as empty text.
    """
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def texts_of(batch, name: str = "text") -> list[str]:
    """The texts of an Arrow batch, with "" for null."""
    return [x or "" for x in batch.column(name).to_pylist()]


def _give_back() -> None:
    """Return free memory to the system; a worker lives on, and others need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # no glibc
        pass


def parts(batches: Iterator[pa.RecordBatch], name: str = "text", most_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most about ``most_bytes`` of text, or one long text.

    Spark's batches have thousands of rows; taken as a whole, their texts and what is made of
    them would fill a worker's memory.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype="i8") // most_bytes
        edges = np.flatnonzero(np.diff(ends, prepend=-1, append=-1) != 0) if len(ends) else [0]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)
    _give_back()


def text_groups(
    batches: Iterator[pa.RecordBatch], most_bytes: int, encode: Callable[[str], bytes] = str.encode
) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Ids and encoded texts, in groups of at most about ``most_bytes`` or one long text."""
    ids: list[int | None] = []
    texts: list[bytes] = []
    size = 0
    for batch in parts(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            ids.append(doc_id)
            texts.append(encode(text))
            size += len(texts[-1])
            if size > most_bytes:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def bare(docs: DataFrame) -> DataFrame:
    """Only doc_id and text, of the types the operators expect."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def keep_rows(docs: DataFrame, judge: Callable[[list[str]], list[bool]]) -> DataFrame:
    """The rows whose text ``judge`` keeps, with all their columns; null text is judged as "".

    Rows are judged where they lie: no shuffle, and ids don't matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            yield batch.filter(pa.array(judge(texts_of(batch)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
