"""Quality scores learned from preference pairs (Bradley-Terry).

Every document gets a score, a linear function of features of its text, such
that the probability that document i is preferred to j is
``1 / (1 + exp(score_j - score_i))``.  The weights minimise the logistic loss
on feature differences of pairs of a good and a bad labelled document.  The
threshold is a quantile of the scores: the one that rejects as large a share
as the labels do.  A reported score is the probability that the document is
preferred to one just at the threshold.

The fit uses every labelled row.  Texts become feature vectors, a few dozen
numbers, where they are read; labelled vectors are dealt into buckets, where
each good row is paired with each bad one, so that pairs grow with the rows.
Means, each Newton step's gradient and Hessian and the counts that lead to the
quantile are summed by Spark: only these sums, whose number doesn't grow, reach
the driver.  Scoring is a map over whole texts without a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import keep_rows, seeds, written
from emporia.session import ship_package

_BYTE = np.zeros(256, np.int64)  # class of each byte of a UTF-8 text
for _k, _chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
                             " \t", "\n\r", ".", ",", "!?", "|", "#$%&*@^~+=<>", "\"'()[]{}:;-_/\\`"], 1):
    _BYTE[list(_chars.encode())] = _k
_BYTE[128:] = 12
_CLASSES = 13

FEATURES = [f"class_{k}" for k in range(_CLASSES)] + [
    "log_words", "mean_word", "upper_start", "repeated_words", "top_word_again", "repeat_next",
    "log_lines", "repeated_lines", "words_per_line", "long_words", "word_end_marks", "is_empty"]

PRIOR_WORDS = 8
#: Rows of a bucket: about so many of the more frequent label, and so many of the other.
BUCKET_ROWS, BUCKET_OTHERS = 64, 32
#: Score ranges counted in one pass on the way to the quantile.
BINS = 1024


def features(text: str | None) -> np.ndarray:
    """Numbers that describe the whole text; none depends on its language's
    vocabulary."""
    out = np.zeros(len(FEATURES))
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        out[-1] = 1.0
        return out
    kinds = np.bincount(_BYTE[np.frombuffer(raw, np.uint8)], minlength=_CLASSES)
    out[:_CLASSES] = kinds / len(raw)
    n = len(words)
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    tail = np.frombuffer(bytes([w[-1] for w in words]), np.uint8)
    head = np.frombuffer(bytes([w[0] for w in words]), np.uint8)
    out[_CLASSES:-1] = [
        math.log1p(n), (len(raw) - kinds[4] - kinds[5]) / n, np.mean(_BYTE[head] == 2), 1 - len(seen) / n,
        (max(seen.values()) - 1) / n, sum(map(eq, words, words[1:])) / n, math.log1p(len(lines)),
        1 - len(set(lines)) / len(lines), math.log1p(n / len(lines)),
        sum([len(w) > 20 for w in words]) / n,
        np.mean((_BYTE[tail] >= 8) & (_BYTE[tail] <= 10))]
    return out


@dataclass
class PairwiseModel:
    """``raw score = standardised features @ weights``; the features of a text
    of n words count for n / (n + ``PRIOR_WORDS``) of what they say, as a few
    words are weak evidence for any share."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        words = np.expm1(x[:, FEATURES.index("log_words")])
        return (x - self.mean) / self.scale * (words / (words + PRIOR_WORDS))[:, None]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.threshold, -500, 500)))


def pair_sums(diff: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weight, gradient and Hessian of the logistic loss of pairs, flat."""
    p = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))  # of preferring the wrong one
    hess = (diff * (weight * p * (1 - p))[:, None]).T @ diff
    return np.concatenate([[weight.sum()], -diff.T @ (weight * p), hess.ravel()])


def newton(sums: Callable[[np.ndarray], np.ndarray], ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights that minimise the mean loss of the pairs that ``sums`` adds up,
    plus ``ridge``."""
    width = len(FEATURES)
    w = np.zeros(width)
    for _ in range(steps):
        found = sums(w)
        grad = found[1:width + 1] / found[0] + ridge * w
        hess = found[width + 1:].reshape(width, width) / found[0] + ridge * np.eye(width)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _scale(deviation: np.ndarray) -> np.ndarray:
    return np.where(deviation < 1e-9, 1.0, deviation)


def bradley_terry(good: np.ndarray, bad: np.ndarray, good_share: float, pairs: int | None = None) -> PairwiseModel:
    """The fit over rows that are at hand, on ``pairs`` pairs that both
    classes' rows are dealt over evenly (default: all pairs).  With rows of one
    class only there is nothing to prefer: every score is then 0.5."""
    rows = np.concatenate([good, bad])
    width = len(FEATURES)
    model = PairwiseModel(rows.mean(axis=0) if len(rows) else np.zeros(width),
                          _scale(rows.std(axis=0)) if len(rows) else np.ones(width), np.zeros(width), 0.0)
    if not len(good) or not len(bad):
        return model
    if pairs is None:
        i, j = np.divmod(np.arange(len(good) * len(bad)), len(bad))
    else:
        mix = seeds(2 * pairs, 31)
        i = np.argsort(mix[:pairs], kind="stable") % len(good)
        j = np.argsort(mix[pairs:], kind="stable") % len(bad)
    diff, weight = model.standard(good)[i] - model.standard(bad)[j], np.ones(len(i))
    model.weights = newton(lambda w: pair_sums(diff, weight, w))
    # quantile of the scores in the labels' proportions
    score = np.concatenate([model.raw(good), model.raw(bad)])
    share = np.concatenate([np.full(len(good), good_share / len(good)),
                            np.full(len(bad), (1 - good_share) / len(bad))])
    order = np.argsort(score, kind="stable")
    k = int(np.searchsorted(np.cumsum(share[order]), 1 - good_share + 1e-12, "right"))
    k = min(max(k, 1), len(order) - 1)
    model.threshold = float((score[order[k - 1]] + score[order[k]]) / 2)
    return model


def labelled_features(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(id, label, x, n): the features of every document of ``marked`` (id,
    label), equal rows once with their number.  Features are taken before the
    join, so that no text is shuffled."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["id", "x"])

    kind = docs.schema["id"].dataType.simpleString()
    return (docs.where(F.col("id").isNotNull()).mapInArrow(describe, f"id {kind}, x array<double>")
            .join(marked.select("id", "label").distinct(), "id")
            .groupBy("id", "label", "x").agg(F.count(F.lit(1)).alias("n")))


def pair_buckets(rows: DataFrame, good: int, bad: int) -> DataFrame:
    """(rows): ``labelled_features`` dealt by hash into buckets of about
    ``BUCKET_ROWS`` of the more frequent label.  Rows of the other label go to as
    many buckets as give each ``BUCKET_OTHERS`` of them; only the first of a
    row's places is marked ``first``."""
    buckets = -(-max(good, bad) // BUCKET_ROWS)
    copies = min(buckets, max(1, -(-BUCKET_OTHERS * buckets // min(good, bad))))
    places = F.when(F.col("label") == int(good < bad), F.lit(copies)).otherwise(F.lit(1))
    at = F.pmod(F.xxhash64("id", "x") + F.col("place"), F.lit(buckets))
    return (rows.withColumn("place", F.explode(F.sequence(F.lit(0), places - 1)))
            .groupBy(at.alias("bucket"))
            .agg(F.sort_array(F.collect_list(F.struct("label", (F.col("place") == 0).alias("first"), "n", "x"))).alias("rows"))
            .select("rows"))


def _arrays(rows: pa.Array, k: int) -> tuple[np.ndarray, ...]:
    """label, first, n and features of the ``k``-th bucket of a column."""
    held = rows[k].values
    label, first, n, x = (held.field(i) for i in range(4))
    return (label.to_numpy(), first.to_numpy(zero_copy_only=False), n.to_numpy().astype(float),
            x.flatten().to_numpy().reshape(-1, len(FEATURES)))


def _bucket_sums(buckets: DataFrame, of: Callable[..., np.ndarray]) -> np.ndarray:
    """The vectors that ``of`` gives for the buckets, added up as decimals, so
    that their order makes no difference."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [of(*_arrays(batch.column(0), k)).tolist() for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.list_(pa.float64()))], ["v"])

    found = (buckets.mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("k", "v"))
             .groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,15)")).alias("v")).collect())
    return np.array([float(r["v"]) for r in sorted(found)])


def score_quantile(scores: DataFrame, share: float) -> float:
    """Of ``scores`` (score, label, n), label 1 counting for 1 - ``share`` of
    all and label 0 for ``share``: halfway between the score at which more than
    ``share`` is reached and the next smaller one (the next larger one, if there
    is none).  Score ranges are counted, then those of the range it lies in, until
    one score is left; there are at most ``BINS`` + 1 of them each time."""
    def number(label: int):
        return F.coalesce(F.sum(F.when(F.col("label") == label, F.col("n"))), F.lit(0))

    told = [number(0).alias("bad"), number(1).alias("good"), F.min("score").alias("low"), F.max("score").alias("high")]
    found = everything = scores.agg(*told).first()
    bad = good = 0
    while found["low"] < found["high"]:
        low, high = found["low"], found["high"]
        part = F.floor((F.col("score") - low) / (high - low) * BINS)
        ranges = sorted(scores.where(F.col("score").between(low, high)).groupBy(part.alias("part")).agg(*told).collect())
        for found in ranges:
            below = share * (bad + found["bad"]) / everything["bad"] + (1 - share) * (good + found["good"]) / everything["good"]
            if below > share + 1e-12 or found is ranges[-1]:
                break
            bad, good = bad + found["bad"], good + found["good"]
    at = found["low"]
    beside = scores.agg(F.max(F.when(F.col("score") < at, F.col("score"))).alias("below"),
                        F.min(F.when(F.col("score") > at, F.col("score"))).alias("above")).first()
    other = beside["below"] if beside["below"] is not None else beside["above"]
    return at if other is None else (at + other) / 2


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality") -> PairwiseModel:
    """Learn from all documents that ``labels`` marks 1 (good) or 0 (bad);
    rows with another or a null label or identifier teach nothing, nor do
    labels of absent documents.  Pairs of rows that occur several times count
    as often.  With documents of one label only there is nothing to prefer:
    every score is then 0.5."""
    ship_package(docs.sparkSession)
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    rows = written(labelled_features(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), marked),
                   "quality-features")
    width = len(FEATURES)
    model = PairwiseModel(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    counts = {r["label"]: r["rows"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).collect()}
    if len(counts) < 2:
        return model
    buckets = written(pair_buckets(rows, counts[1], counts[0]), "quality-buckets")

    def total(label, first, n, x):
        return np.concatenate([[n[first].sum()], n[first] @ x[first]])

    def spread(label, first, n, x):
        return n[first] @ (x[first] - model.mean) ** 2

    def loss(w):
        def of(label, first, n, x):
            z, good = model.standard(x), label == 1
            diff = (z[good][:, None] - z[~good][None]).reshape(-1, width)
            return pair_sums(diff, np.outer(n[good], n[~good]).ravel(), w)

        return _bucket_sums(buckets, of)

    found = _bucket_sums(buckets, total)
    model.mean = found[1:] / found[0]
    model.scale = _scale(np.sqrt(_bucket_sums(buckets, spread) / found[0]))
    model.weights = newton(loss)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                label, first, n, x = _arrays(batch.column(0), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(model.raw(x)[first]), pa.array(label[first]), pa.array(n[first].astype(np.int64))],
                    ["score", "label", "n"])

    share = marked.agg(F.avg("label")).first()[0]
    scores = written(buckets.mapInArrow(scored, "score double, label int, n long"), "quality-scores")
    model.threshold = score_quantile(scores, 1 - share)
    return model


def score_quality(docs: DataFrame, model: PairwiseModel, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: the identifier, ``score`` (0 to 1, higher is
    better) and ``predicted`` (1 if the score is at least 0.5).

    A null, empty or blank text is scored by the features of an empty text.
    Null and repeated identifiers pass through; other columns are not read.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: PairwiseModel, text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``min_score``."""
    def judge():
        return lambda texts: (model.score(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES)))
                              >= min_score).tolist()

    return keep_rows(docs, text_col, judge)
