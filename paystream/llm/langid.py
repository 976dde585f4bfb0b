"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystream.llm.common import parts, texts_of

#: Odd factors of the hash, one for each character of an n-gram and one for its length.
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], "u4")
_BLOCK = 1 << 18


def _ngrams(text: str, bits: int, longest: int) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of 1 to ``longest`` characters that start in each block of the text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    for at in range(0, len(points), _BLOCK):
        block = points[at:at + _BLOCK + longest - 1]
        starts = min(_BLOCK, len(points) - at)
        key = np.zeros(len(block), "u4")
        for n in range(longest):
            size = min(starts, len(block) - n)
            if size <= 0:
                break
            key = key[:size] + block[n:n + size] * _FACTORS[n]
            mixed = (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
            yield mixed >> np.uint32(32 - bits)


def _counts(text: str, bits: int, longest: int) -> np.ndarray:
    total = np.zeros(1 << bits, "i8")
    for found in _ngrams(text, bits, longest):
        total += np.bincount(found, minlength=1 << bits)
    return total


class Model:
    """Log probabilities, one row per bucket and one column per language."""

    def __init__(self, langs: list[str], table: np.ndarray, prior: np.ndarray, bits: int, longest: int) -> None:
        self.langs, self.table, self.prior, self.bits, self.longest = langs, table, prior, bits, longest

    def score(self, text: str) -> np.ndarray:
        total, n = self.prior.copy(), 0
        for found in _ngrams(text, self.bits, self.longest):
            # The sparse row of a text holds few of the buckets when it is short, many when long.
            if len(found) < 1 << self.bits:
                total += self.table[found].sum(axis=0, dtype="f8")
            else:
                total += np.bincount(found, minlength=1 << self.bits) @ self.table
            n += len(found)
        return total


def train(
    labelled: DataFrame, bits: int = 14, longest: int = 3, max_train: int = 60_000,
    alpha: float = 0.5, max_langs: int = 1000,
) -> Model:
    """Fit on the rows of ``labelled`` (doc_id, text, lang) that have a language.

    ``max_train`` bounds the training rows: where there are more, the documents whose hashed id
    falls below the matching share are taken, which is a uniform sample of about that many.
    The model has ``2 ** bits`` rows and at most ``max_langs`` columns, whatever the input.
    """
    rows = labelled.where(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    by_lang = rows.groupBy("lang").count().orderBy("lang").limit(max_langs + 1).collect()
    langs = [r["lang"] for r in by_lang]
    if len(langs) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    total = sum(r["count"] for r in by_lang)
    if total > max_train:
        scale = 1 << 30
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < int(scale * max_train / total))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in parts(batches):
            for text, lang in zip(texts_of(batch), batch.column("lang").to_pylist()):
                if lang not in seen:
                    seen[lang] = np.zeros(1 << bits, "i8")
                seen[lang] += _counts(text, bits, longest)
        for lang, found in seen.items():
            bucket = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(bucket), pa.string()), pa.array(bucket.astype("i4")), pa.array(found[bucket])],
                ["lang", "bucket", "n"],
            )

    counted = rows.mapInArrow(count, "lang string, bucket int, n long")
    index = {lang: k for k, lang in enumerate(langs)}
    table = np.full((1 << bits, len(langs)), alpha)
    for r in counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        table[r["bucket"], index[r["lang"]]] += r["n"]
    table = np.log(table / table.sum(axis=0)).astype("f4") if langs else table.astype("f4")
    prior = np.log([r["count"] / total for r in by_lang]) if langs else np.zeros(0)
    return Model(langs, table, prior, bits, longest)


def identify(docs: DataFrame, model: Model, unknown: str = "und") -> DataFrame:
    """Language and score of every whole text: doc_id, lang_pred, score, log_odds, n_letters.

    ``score`` is the model's probability of the language it names, ``log_odds`` its lead over
    the next one. Texts that are null or have no letter, and all texts if the model knows no
    language, are ``unknown`` with score 0. Ties go to the language first in the alphabet.
    Repeated rows are judged each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in parts(batches):
            out: list[tuple] = []
            for text, letters in zip(texts_of(batch), batch.column("n_letters").to_pylist()):
                if not letters or not known.langs:
                    out.append((unknown, 0.0, 0.0))
                    continue
                log = known.score(text)
                best = int(log.argmax())
                lead = float(log[best] - np.delete(log, best).max()) if len(log) > 1 else 0.0
                out.append((known.langs[best], float(1 / np.exp(log - log[best]).sum()), lead))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([x[0] for x in out], pa.string()),
                    pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.float64()),
                    batch.column("n_letters"),
                ],
                ["doc_id", "lang_pred", "score", "log_odds", "n_letters"],
            )

    letters = F.length(F.regexp_replace(F.col("text"), r"\P{L}+", "")).cast("long")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), letters.alias("n_letters")
    ).mapInArrow(run, "doc_id long, lang_pred string, score double, log_odds double, n_letters long")
