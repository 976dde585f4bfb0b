"""Toxic passages: maximum-scoring segments over token log-odds, with extreme-value statistics.

Words, and stems that inflected words share, get the log-odds of toxic against clean training
documents under a Dirichlet prior; words that say nothing cost a little. The maximal segments of a text under these scores are its
passages. How many segments of a score a clean text would have by chance follows an extreme-value
law, whose parameters come from the clean training documents; it makes the scores of short and
long texts comparable.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystream.llm.common import parts, texts_of

_WORD = re.compile(r"\w+")
PASSAGES = "doc_id long, score double, n_words long, evidence double, passages array<struct<start:long,end:long,score:double,expected:double>>"
_PASSAGE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
#: The most evidence (-log10 of the expected number by chance) that is told apart.
_MOST = 40.0


#: Lengths of the starts of words that count as stems; the sign after a stem is in no word.
_STEMS = (4, 5, 6)
_MEMO = 60_000


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def terms_of(word: str) -> list[str]:
    """The word and its stems."""
    return [word, *(word[:k] + "*" for k in _STEMS if len(word) > k)]


def all_terms(words: set[str]) -> set[str]:
    return {t for w in words for t in terms_of(w)}


def segments(scored: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a text, in one pass.

    ``scored`` has the positions and scores of the words that have one, in order; every other
    word costs ``drift``. A segment is maximal if no part beside it could be joined with gain.
    Each candidate is kept with the running total before it and after it; one that can't be
    joined with an earlier one stays, else all between the two become one.
    """
    total, at = 0.0, 0
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, total before, total after, earlier one with a lower start
    for position, score in scored:
        total -= drift * (position - at)
        at = position + 1
        before, total = total, total + score
        if score <= 0:
            continue
        start, low = position, before
        while True:
            link = len(stack) - 1
            while link >= 0 and stack[link][2] >= low:
                link = stack[link][4]
            if link < 0 or stack[link][3] >= total:
                stack.append((start, at, low, total, link))
                break
            start, low = stack[link][0], stack[link][2]
            del stack[link:]
    return [(start, end, after - before) for start, end, before, after, _ in stack]


@dataclass(frozen=True)
class Model:
    """Scores of words and the constants of the chance law and the final curve."""

    scores: dict[str, float]
    drift: float
    decay: float
    rate: float
    slope: float
    offset: float
    floor: float
    memo: dict[str, float] = field(default_factory=dict, compare=False)

    def expected(self, score: float, n_words: int) -> float:
        """How many segments of at least this score a clean text of this length has by chance."""
        return self.rate * n_words * math.exp(-min(700.0, self.decay * score))

    def _score(self, word: str) -> float:
        """The highest score among the word's terms that have one, else 0."""
        if len(self.memo) > _MEMO:
            self.memo.clear()
        found = self.memo[word] = max((self.scores[t] for t in terms_of(word) if t in self.scores), default=0.0)
        return found

    def passages(self, words: list[str], most: float = 0.05) -> list[tuple[int, int, float, float]]:
        """Significant segments (start, end, score, expected by chance)."""
        memo = self.memo
        told = {w: s for w in set(words) if (s := memo[w] if w in memo else self._score(w))}
        if not told:
            return []
        hits = [(k, told[w]) for k, w in enumerate(words) if w in told]
        found = ((a, b, s, self.expected(s, len(words))) for a, b, s in segments(hits, self.drift))
        return [x for x in found if x[3] <= most]

    def evidence(self, passages: list[tuple[int, int, float, float]]) -> float:
        best = min((p[3] for p in passages), default=1.0)
        return min(_MOST, max(0.0, -math.log10(max(best, 1e-300))))

    def probability(self, evidence: float) -> float:
        if evidence <= 0:
            return self.floor
        return 1 / (1 + math.exp(-(self.slope * evidence + self.offset)))


def _sketch(words: list[str]) -> int:
    """The same for most near copies of a text: the least hash of three words in a row."""
    if len(words) < 3:
        return zlib.crc32(" ".join(words).encode())
    return min(zlib.crc32(f"{a} {b} {c}".encode()) for a, b, c in zip(words, words[1:], words[2:]))


def _count_terms(batches: Iterator[pa.RecordBatch], terms: frozenset[str] | None) -> Iterator[pa.RecordBatch]:
    """With ``terms``: documents that have each of them, and all terms. Else each term with the sketch of its document."""
    seen: Counter[str] = Counter()
    for batch in parts(batches):
        for text in texts_of(batch):
            words = words_of(text)
            own = all_terms(set(words))
            if terms is None:
                sketch = [_sketch(words)] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array(sketch, pa.int64())], ["word", "n"])
            else:
                seen.update(own & terms)
                seen[""] += len(own)
    if terms is not None:
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def _decay(scores: np.ndarray, share: np.ndarray, drift: float) -> float:
    """The positive root of: mean of exp(decay * score) over clean words is 1."""
    rest = 1 - share.sum()

    def mean(x: float) -> float:
        return float(rest * math.exp(-x * drift) + (share * np.exp(np.minimum(x * scores, 600))).sum())

    low, high = 1e-6, 1.0
    while mean(high) < 1 and high < 1e4:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return high


def train(
    docs: DataFrame, labels: DataFrame, max_train: int = 50_000, max_terms: int = 65_536,
    least_documents: int = 3, prior: float = 0.1, least_z: float = 3.0, drift: float = 0.1,
) -> Model:
    """Learn from documents (doc_id, text) whose ``labels`` (doc_id, toxic) are known.

    ``max_train`` bounds the labelled rows: of more, a share of about that many is taken by
    hashed id; these ids and labels are broadcast, so no text is shuffled. ``max_terms`` bounds
    the words that get a score (most frequent in toxic documents first), hence the model that
    is broadcast. Near copies of a toxic document count once for a word. Rows with a null label
    or id teach nothing; of several labels of a document the largest counts. Without toxic
    documents every text gets the same low score.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "toxic")
    total = known.count()
    if total > max_train:
        scale = 1 << 30
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < int(scale * max_train / total))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id")
    toxic, clean = rows.where("toxic = 1").select("text"), rows.where("toxic = 0").select("text")

    words = toxic.mapInArrow(lambda b: _count_terms(b, None), "word string, n long")
    counts = words.groupBy("word").agg(F.countDistinct("n").alias("n"))
    often = counts.where(F.col("n") >= least_documents).orderBy(F.desc("n"), "word").limit(max_terms).collect()
    n_toxic = counts.agg(F.sum("n")).first()[0] or 0
    if not often:
        return Model({}, drift, 1.0, 1.0, 0.0, 0.0, 0.0)
    names = frozenset(r["word"] for r in often)
    shared_names = docs.sparkSession.sparkContext.broadcast(names)
    counted = clean.mapInArrow(lambda b: _count_terms(b, shared_names.value), "word string, n long")
    in_clean = {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    shared_names.destroy()
    n_clean = in_clean.pop("", 0)

    a = np.array([r["n"] for r in often], "f8")
    b = np.array([in_clean.get(r["word"], 0) for r in often], "f8")
    strength = prior * (n_toxic + n_clean)
    alpha = strength * (a + b) / (n_toxic + n_clean)
    delta = np.log((a + alpha) / (n_toxic + strength - a - alpha)) - np.log((b + alpha) / (n_clean + strength - b - alpha))
    z = delta / np.sqrt(1 / (a + alpha) + 1 / (b + alpha))
    told = np.abs(z) >= least_z
    if not (told & (delta > 0)).any():
        return Model({}, drift, 1.0, 1.0, 0.0, 0.0, 0.0)
    scores = {r["word"]: float(d) for r, d, t in zip(often, delta, told) if t}
    share = (b[told] + 0.5) / (n_clean + 0.5 * told.sum() + 1)
    decay = _decay(delta[told], share, drift)
    return _calibrate(rows, Model(scores, drift, decay, 1.0, 1.0, 0.0, 0.0))


def _calibrate(rows: DataFrame, raw: Model, bins: int = 400) -> Model:
    """Fit the rate of chance segments on the clean rows, then the curve on the evidence of all."""
    shared = rows.sparkSession.sparkContext.broadcast(raw)

    def chance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, found, n = shared.value, 0, 0
        for batch in parts(batches):
            for text in texts_of(batch):
                words = words_of(text)
                n += len(words)
                found += len(model.passages(words, math.inf))
        yield pa.RecordBatch.from_arrays([pa.array([found]), pa.array([n])], ["found", "n"])

    clean = rows.where("toxic = 0").select("text").mapInArrow(chance, "found long, n long")
    found, n = clean.agg(F.coalesce(F.sum("found"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    shared.destroy()
    least = min(s for s in raw.scores.values() if s > 0)
    rate = (found + 0.5) / (max(n, 1) * math.exp(-raw.decay * least))
    fitted = Model(raw.scores, raw.drift, raw.decay, rate, 1.0, 0.0, 0.0)
    shared_fit = rows.sparkSession.sparkContext.broadcast(fitted)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = shared_fit.value, Counter()
        for batch in parts(batches):
            for text, toxic in zip(texts_of(batch), batch.column("toxic").to_pylist()):
                x = model.evidence(model.passages(words_of(text)))
                seen[(0 if x <= 0 else 1 + int(x / _MOST * (bins - 1)), int(toxic == 1))] += 1
        for (k, toxic), n in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([toxic], pa.int32()), pa.array([n])], ["bin", "toxic", "n"])

    told = rows.select("text", "toxic").mapInArrow(histogram, "bin int, toxic int, n long")
    seen = np.zeros((bins + 1, 2))
    for r in told.groupBy("bin", "toxic").agg(F.sum("n").alias("n")).collect():
        seen[r["bin"], r["toxic"]] += r["n"]
    shared_fit.destroy()
    floor = (seen[0, 1] + 1) / (seen[0].sum() + 2)
    x = (np.arange(bins) + 0.5) / (bins - 1) * _MOST
    slope, offset = _curve(x, seen[1:, 0], seen[1:, 1])
    return Model(raw.scores, raw.drift, raw.decay, rate, slope, offset, float(floor))


def _curve(x: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic curve through the shares of toxic documents, with one more of each kind."""
    n0, n1 = clean.sum(), toxic.sum()
    high, low = (n1 + 1) / (n1 + 2), 1 / (n0 + 2)
    w, goal = clean + toxic, clean * low + toxic * high
    beta = np.array([0.0, math.log((n1 + 1) / (n0 + 1))])
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slack = np.diag([1e-2, 1e-4])
        gradient = design.T @ (goal - w * p) - slack @ beta
        hessian = (design * (w * p * (1 - p))[:, None]).T @ design + slack
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(beta[0])), float(beta[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score and passages of every whole text.

    ``score`` is the probability of the label toxic, ``evidence`` the -log10 of how often chance
    brings the best passage, ``passages`` every significant one in words (end not included).
    Null and empty texts have no words, no passages and the score of texts without a passage.
    Repeated rows are scored each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in parts(batches):
            sizes, evidence, found = [], [], []
            for text in texts_of(batch):
                words = words_of(text)
                passages = known.passages(words)
                sizes.append(len(words))
                evidence.append(known.evidence(passages))
                found.append([dict(zip(("start", "end", "score", "expected"), p)) for p in passages])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([known.probability(x) for x in evidence], pa.float64()),
                    pa.array(sizes, pa.int64()), pa.array(evidence, pa.float64()), pa.array(found, _PASSAGE),
                ],
                ["doc_id", "score", "n_words", "evidence", "passages"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PASSAGES)
