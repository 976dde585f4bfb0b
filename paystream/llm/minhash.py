"""Near duplicates: one-permutation hashing, banded buckets, star-shaped candidate edges.

Documents with the same set of shingles are one class from the start, whatever their number.
Each class gets a signature: its shingles fall into bins by the first bits of their hash, the
least hash of a bin is its value, and an empty bin borrows from a bin drawn by a fixed hash
until one is found that is not empty (optimal densification). Equal bands of the signature make
a bucket. In a bucket, only edges from a few centers to the other members are candidates, which
are then confirmed on the full texts; buckets whose members still lie in different components
get more centers in the next round, until all their pairs across components have been tried.
Components are found by alternating large and small stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paystream.llm.common import parts, texts_of
from paystream.llm.hashing import _ODD, mix, run_hashes, word_hashes
from paystream.session import work_dir

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SKETCH = "doc_id long, row long, n_shingles long, print_a long, print_b long, bands array<long>"

#: Shingles a task holds while it confirms.
_HELD = 400_000


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes, in order, of the runs of ``width`` words; fewer words are one run."""
    if 0 < len(words) < width:
        return run_hashes(words, len(words)) ^ np.uint64(len(words))
    return np.unique(run_hashes(words, width))


class Signer:
    """Signatures of ``bins`` values (a power of two) and their bands of ``rows`` values."""

    def __init__(self, bins: int, rows: int) -> None:
        self.bins, self.rows = bins, rows
        self.shift = np.uint64(64 - bins.bit_length() + 1)
        tries = np.arange(64 * bins, dtype="u8").reshape(64, bins)
        # Which bin an empty one asks at each try, and last all in turn.
        self.donors = (mix(tries * _ODD[0] + np.uint64(1)) % np.uint64(bins)).astype("i8")

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        """The signature of a set that is not empty, given in order."""
        bins = (shingles >> self.shift).astype("i8")
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        full = np.zeros(self.bins, bool)
        full[bins[first]] = True
        values = np.zeros(self.bins, "u8")
        values[bins[first]] = shingles[first]
        if len(first) < self.bins:
            empty = np.flatnonzero(~full)
            for donors in self.donors:
                asked = donors[empty]
                found = full[asked]
                values[empty[found]] = values[asked[found]]
                empty = empty[~found]
                if not len(empty):
                    break
            values[empty] = shingles[first[0]]
        return values

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        parts = self.sign(shingles).reshape(-1, self.rows) * _ODD[:self.rows]
        return mix(mix(parts).sum(axis=1, dtype="u8") + np.arange(len(parts), dtype="u8"))


def row_key() -> Column:
    """A 64-bit name of a row's id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and row, the key of both."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("row"))


def sketches(docs: DataFrame, width: int, bins: int, rows: int) -> DataFrame:
    """Size, fingerprint and band hashes of the shingle set of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(bins, rows)
        for batch in parts(batches):
            texts = [x.encode().translate(_LOWER) for x in texts_of(batch)]
            words, starts = word_hashes(texts)
            sizes, prints, bands = [], [[], []], []
            for k in range(len(texts)):
                found = shingle_hashes(words[starts[k]:starts[k + 1]], width)
                sizes.append(len(found))
                prints[0].append(mix(found + _ODD[1]).sum(dtype="u8"))
                prints[1].append(mix(found ^ _ODD[2]).sum(dtype="u8"))
                bands.append(signer.bands(found).view("i8") if len(found) else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row"), pa.array(sizes, pa.int64()),
                    *(pa.array(np.array(p, "u8").view("i8"), pa.int64()) for p in prints),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "row", "n_shingles", "print_a", "print_b", "bands"],
            )

    found = keyed(docs).mapInArrow(run, _SKETCH)
    # Documents without shingles are never joined; their keys are spread by row.
    own = F.when(F.col("n_shingles") == 0, F.xxhash64("row"))
    return found.withColumn("print_a", F.coalesce(own, F.col("print_a")))


def bodies(docs: DataFrame) -> DataFrame:
    """Texts compressed one by one: doc_id (the key of the row), body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(3)
        for batch in parts(batches):
            packed = [press.compress(x.encode()) for x in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(packed, pa.binary())], ["doc_id", "body"])

    return keyed(docs).mapInArrow(run, "doc_id long, body binary")


def _shingle_set(body: bytes, width: int) -> frozenset[bytes]:
    """The shingles, each as its words with a blank between them."""
    words = zstandard.ZstdDecompressor().decompress(body).translate(_LOWER).split()
    if len(words) < width:
        return frozenset([b" ".join(words)] if words else [])
    return frozenset(map(b" ".join, zip(*(words[k:] for k in range(width)))))


def confirm(edges: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges (a, b) whose texts share at least ``percent`` hundredths of all their shingles.

    Texts that come again in a task, as the members of large groups do, are taken apart once:
    a bounded number of shingles is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, frozenset] = {}
        held = 0
        for batch in parts(batches, "body_b", 500_000):
            keep = []
            pairs = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("body_a"), batch.column("body_b"))
            for k, (a, b, body_a, body_b) in enumerate(pairs):
                if held > _HELD:
                    known.clear()
                    held = 0
                for name, body in ((a, body_a), (b, body_b)):
                    if name not in known:
                        known[name] = _shingle_set(body.as_py(), width)
                        held += len(known[name])
                one, other = known[a], known[b]
                common = len(one & other)
                if 100 * common >= percent * (len(one) + len(other) - common):
                    keep.append(k)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    first = texts.select(F.col("doc_id").alias("a"), F.col("body").alias("body_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("body").alias("body_b"))
    return edges.join(second, "b").join(first, "a").select("a", "b", "body_a", "body_b").mapInArrow(run, "a long, b long")


def _saved(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to a new table in the shared folder and read back."""
    path = work_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def components(edges: DataFrame, name: str = "component") -> DataFrame:
    """Least node reachable from each node of undirected ``edges`` (a, b): node, component.

    Large and small stars in turn; each pass is a few aggregations and joins on nodes, and no
    node's neighbours are ever gathered.
    """
    now = _saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias(name))
        state = tuple(seen)
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").selectExpr("b AS a", "m AS b").where("a <> b").union(low.selectExpr("a", "m AS b"))
        now = _saved(small.distinct(), "edges")


def _prefixes(texts: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """Postings of the rarest shingles of each of ``reps``: bucket, rep, n, shared.

    With shingles in the order of how many of ``reps`` have them, two sets that are linked have
    their first common shingle among the first ``n - percent * n + 1`` of each, and from there
    on enough others for the link. ``bucket`` is the shingle, ``shared`` the number of shingles
    from it on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in parts(batches, "body", 500_000):
            plain = [unpress.decompress(x.as_py()).translate(_LOWER) for x in batch.column("body")]
            words, starts = word_hashes(plain)
            found = [shingle_hashes(words[starts[k]:starts[k + 1]], width).view("i8") for k in range(len(plain))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], ["rep", "shingles"])

    sets = texts.join(reps, F.col("doc_id") == F.col("rep"), "left_semi").mapInArrow(run, "rep long, shingles array<long>")
    own = sets.select("rep", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("bucket"))
    often = own.groupBy("bucket").agg(F.count("*").alias("often"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("often", "bucket"))
    return own.join(often, "bucket").withColumn("place", place).where("often > 1").where(
        F.col("place") * 100 <= F.col("n") * (100 - percent) + 100
    ).select("bucket", "rep", "n", (F.col("n") - F.col("place") + 1).alias("shared"))


def _peel(members: DataFrame, reach: float) -> DataFrame:
    """Members of buckets that may have a link to a member of another component there.

    A link needs ``n + n' <= reach * shared``: the common shingles must be enough for the two
    sizes. n' is at least the least size that members of other components have.
    """
    per = members.groupBy("bucket", "part").agg(F.min("n").alias("m"))
    one = per.groupBy("bucket").agg(F.min(F.struct("m", "part")).alias("one")).select("bucket", F.col("one.m").alias("m_one"), F.col("one.part").alias("p_one"))
    two = per.join(one, "bucket").where("part <> p_one").groupBy("bucket").agg(F.min("m").alias("m_two"), F.min("m_one").alias("m_one"), F.min("p_one").alias("p_one"))
    other = F.when(F.col("part") == F.col("p_one"), F.col("m_two")).otherwise(F.col("m_one"))
    return members.join(two, "bucket").where(F.col("n") + other <= reach * F.col("shared")).select(*members.columns)


def _links(members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Components of the classes in ``members`` (bucket, rep, size of its set): node, component.

    Centers are first the least member of each bucket, then the one with most links so far.
    Members of buckets that still hold several components are then dealt out anew, by their
    rarest shingles. A copy with edits of its own meets few others there, whereas it shared
    bands with all its group; and members that can't have enough in common with any member of
    another component are settled by counting. What is left gets 16, 256, ... drawn centers
    until all pairs have been tried. Pairs that were tried, are in one component already, or
    can't be linked by their counts are not tried.
    """
    spark = members.sparkSession
    reach = (100 + percent) / percent + 1e-9
    edges, tried = None, None
    label = spark.createDataFrame([], "node long, component long")
    open_members, rounds = members.withColumn("links", F.lit(0).cast("long")).withColumn("shared", F.col("n")), 0
    columns = ["bucket", "rep", "n", "links", "shared"]
    while True:
        at = open_members.select(*columns).join(label, F.col("rep") == F.col("node"), "left").select(
            *columns, F.coalesce("component", "rep").alias("part")
        )
        if rounds == 2:
            reps = _saved(_peel(at, reach).groupBy("rep").agg(F.min("part").alias("part")), "open")
            dealt = _prefixes(texts, reps.select("rep"), width, percent).join(reps, "rep")
            at = _saved(dealt.withColumn("links", F.lit(0).cast("long")).select(*columns, "part"), "prefixes")
        if rounds >= 2:
            at = _peel(_saved(_peel(at, reach), "peeled"), reach)
        best = F.max(F.struct("links", (-F.col("rep")).alias("rep")))["rep"]
        mixed = at.groupBy("bucket").agg(
            F.count("*").alias("size"), F.min("part").alias("low"), F.max("part").alias("high"), (-best).alias("hub")
        ).where("low < high").select("bucket", "size", "hub")
        if rounds:
            # Buckets that were smaller have tried all pairs.
            mixed = mixed.where(F.col("size") > (1 if rounds >= 2 else 2))
        open_members = _saved(at.join(mixed, "bucket"), "buckets")
        if open_members.isEmpty():
            return label
        if rounds <= 1:  # without links, the hub is the least
            center = F.col("rep") == F.col("hub")
        else:
            centers = 16 ** (rounds - 1)
            draw = F.pmod(F.xxhash64("rep", "bucket"), F.lit(1 << 30)) / float(1 << 30)
            center = (F.col("size") <= centers) | (draw < F.lit(float(centers)) / F.col("size"))
        stars = open_members.where(center).select(
            "bucket", F.col("rep").alias("a"), F.col("part").alias("part_a"), F.col("n").alias("n_a"), F.col("shared").alias("shared_a")
        )
        pairs = stars.join(open_members, "bucket").where("part <> part_a").where(
            F.col("n") + F.col("n_a") <= reach * F.least("shared", "shared_a")
        ).select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = _saved(pairs, "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        found = _saved(confirm(pairs, texts, width, percent), "links")
        if not found.isEmpty():
            edges = found if edges is None else edges.union(found)
            label = components(edges)
        if not rounds and edges is not None:
            degree = edges.select(F.col("a").alias("rep")).union(edges.select("b")).groupBy("rep").count()
            open_members = open_members.drop("links").join(degree, "rep", "left").withColumn("links", F.coalesce("count", F.lit(0).cast("long")))
        if rounds >= 2:  # these have tried all pairs
            open_members = open_members.where(F.col("size") > centers)
        rounds += 1


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bins: int = 128, rows: int = 4,
) -> DataFrame:
    """Groups of near duplicates: doc_id, n_shingles, class_id, component_id, kept, row, first.

    Two documents are linked if they share at least ``percent`` hundredths of their distinct
    runs of ``width`` words (A-Z in lower case; fewer words are one run). ``class_id`` is the
    least id with the same set, ``component_id`` the least one that links lead to, ``kept`` says
    whether that is the document itself. With 32 bands of 4 values a pair at the limit of 0.8
    misses every bucket with a chance of 5e-8; a pair in a bucket is never missed.

    Null, empty and blank texts have no shingles and are linked with nothing. Null ids join the
    group of their text but never name one; if all are null, so are class and component, and
    the documents are kept. Repeated rows are in one group and come back each. Rows are told
    apart by ``row``, a hash of id and text, and ``first`` is that of the one row of the
    component that has the least id, if any, and the least hash; null without shingles. Other
    columns are ignored.
    """
    known = _saved(sketches(docs, width, bins, rows), "sketches")
    key = ["print_a", "print_b", "n_shingles"]
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    classes = _saved(
        known.where("n_shingles > 0").groupBy(*key).agg(F.min(order).alias("first"), F.any_value("bands").alias("bands"))
        .select(*key, "first", F.col("first.row").alias("rep"), "bands"),
        "classes",
    )
    spread = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = _saved(spread.join(shared, "bucket").select("bucket", "rep", "n"), "members")
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = _saved(bodies(docs).join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "bodies")
    label = _links(members, texts, width, percent)
    named = classes.select(*key, "rep", "first").join(label, F.col("rep") == F.col("node"), "left").select(
        *key, "first", F.coalesce("component", "rep").alias("component")
    )
    heads = named.groupBy("component").agg(F.min("first").alias("head"))
    named = named.join(heads, "component").select(
        *key, F.col("first.doc_id").alias("class_id"), F.col("head.doc_id").alias("component_id"), F.col("head.row").alias("first")
    )
    own = known.select("doc_id", "row", *key).join(named, key, "left")
    return own.select(
        "doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"), "row", "first",
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def first_rows(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, repeated rows and null ids included.

    It is the ``first`` of ``near_duplicates``; of rows that repeat it, the least by all columns.
    Rows without shingles are in no group and stay.
    """
    groups = _saved(near_duplicates(docs).where("first IS NOT NULL").select("row", "first"), "groups")
    gone = groups.where("row <> first").select("row").distinct()
    many = groups.where("row = first").groupBy("row").count().where("count > 1").select("row")
    rows = docs.withColumn("row", row_key())
    single = rows.join(gone.union(many), "row", "left_anti").select(*docs.columns)
    least = rows.join(many, "row", "left_semi").groupBy("row").agg(F.min(F.struct(*docs.columns)).alias("least"))
    return single.union(least.select("least.*"))
