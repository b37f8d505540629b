"""Toxicity by a classifier chain.

The categories are predicted one after the other by linear models; each later model also reads the
probabilities of the categories before it.  For training, those probabilities come from folds whose
models did not see the text, so later models meet the same kind of input as in use.  Features are
whole words and their first four, five and six bytes, hashed; the ones that tell the categories
apart best are kept.

The model is fitted on at most ``PER_CLASS`` toxic and as many other labelled texts.  It is a few
thousand numbers and goes to the tasks with the function that scores whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyloom.llm.registry import query, table
from tallyloom.llm.shingles import SpanHasher, word_spans

FEATURE_BITS = 20
KEPT_FEATURES = 400
PER_CLASS = 1500
TEXTS_PER_ID = 8
LEAST_CHI_SQUARED = 25.0
RARE_SHARE = 0.03
FOLDS = 5
PREFIXES = (4, 5, 6)
_OTHERS = re.compile(r"[\W\d_]+")

# Words that tell the categories of a toxic text apart, where a label does not.
CATEGORY_WORDS = {
    "insult": ("idiot", "moron", "loser", "clown", "scum"),
    "contempt": ("pathetic", "worthless", "disgusting", "stupid", "trash"),
}


def text_features(hasher: SpanHasher, text: str | None) -> np.ndarray:
    """Distinct feature numbers of the whole text; none for null or a text without letters."""
    data = _OTHERS.sub(" ", text.lower()).strip().encode("utf-8", "surrogatepass") if text else b""
    if not data:
        return np.zeros(0, np.int64)
    found = []
    step = 1 << 20
    for at in _cuts(data, step):
        starts, ends = word_spans(at)
        spans = [(starts, ends)]
        for length in PREFIXES:
            longer = ends - starts > length
            spans.append((starts[longer], starts[longer] + length))
        all_starts, all_ends = (np.concatenate(x) for x in zip(*spans))
        found.append(np.unique(hasher(at, all_starts, all_ends) >> np.uint64(64 - FEATURE_BITS)))
    return np.unique(np.concatenate(found)).astype(np.int64)


def _cuts(data: bytes, step: int) -> Iterator[bytes]:
    """Pieces of about ``step`` bytes that end between words."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + step) if at + step < len(data) else -1
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end + 1


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Newton steps; the last weight is the intercept and is not shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    shrink = np.full(len(w), ridge)
    shrink[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        weight = np.maximum(p * (1 - p), 1e-4)
        step = np.linalg.solve((x.T * weight) @ x + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _chance(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass(frozen=True)
class ToxicityChain:
    categories: tuple[str, ...]
    features: np.ndarray  # sorted feature numbers
    weights: tuple[np.ndarray, ...]
    threshold: float

    def chances(self, found: np.ndarray) -> list[float]:
        """Probability per category for the distinct features of a text."""
        n = len(self.features)
        places = np.searchsorted(self.features, found)
        hit = places[self.features[np.minimum(places, n - 1)] == found] if n else places[:0]
        chances: list[float] = []
        for w in self.weights:
            z = w[hit].sum() + w[-1] + float(np.dot(w[n:-1], chances))
            chances.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return chances


def train(
    bags: list[np.ndarray], labels: np.ndarray, categories: tuple[str, ...], kept: int = KEPT_FEATURES
) -> ToxicityChain:
    """``labels``: one column of 0 and 1 per category, in chain order.

    The threshold on the last category is the probability that gives its out-of-fold predictions
    the best F1.  Without texts of both kinds nothing is ever toxic.
    """
    last = labels[:, -1] if len(labels) else np.zeros(0)
    if not 0 < last.sum() < len(last):
        return ToxicityChain(categories, np.zeros(0, np.int64), tuple(
            np.concatenate([np.zeros(k), [-30.0]]) for k in range(len(categories))), 0.5)
    # Copies of one text would lend their chance words the weight of a habit.
    once = sorted({(b.tobytes(), tuple(y)): i for i, (b, y) in reversed(list(enumerate(zip(bags, labels))))}.values())
    bags, labels = [bags[i] for i in once], labels[once]
    last = labels[:, -1]
    numbers, column = np.unique(np.concatenate(bags), return_inverse=True)
    row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    seen = np.bincount(column, minlength=len(numbers))
    best = np.zeros(len(numbers))
    for y in labels.T:
        n, total = len(y), y.sum()
        if not 0 < total < n:
            continue
        both = np.bincount(column, weights=y[row], minlength=len(numbers))
        gap = both * n - seen * total
        best = np.maximum(best, gap.astype(float) ** 2 / (seen * (n - seen + 1.0) * total * (n - total)))
    # A feature must tell a category apart beyond chance; the best phi squared times the texts is chi squared.
    rare = max(3.0, RARE_SHARE * min(last.sum(), len(last) - last.sum()))
    best[(seen < rare) | (best * len(bags) < LEAST_CHI_SQUARED)] = 0
    ranked = np.argsort(-best, kind="stable")[:kept]
    chosen = np.sort(ranked[best[ranked] > 0])
    slot = np.full(len(numbers), -1)
    slot[chosen] = np.arange(len(chosen))
    x = np.zeros((len(bags), len(chosen)), np.float64)
    inside = slot[column] >= 0
    x[row[inside], slot[column][inside]] = 1
    fold = np.arange(len(bags)) % FOLDS
    weights = []
    for y in labels.T:
        out = np.zeros(len(y))
        for k in range(FOLDS):
            out[fold == k] = _chance(x[fold == k], fit_logistic(x[fold != k], y[fold != k]))
        weights.append(fit_logistic(x, y))
        x = np.hstack([x, out[:, None]])
    falling = np.argsort(-out, kind="stable")
    hits = np.cumsum(last[falling])
    f1 = 2 * hits / (np.arange(1, len(last) + 1) + last.sum())
    at = int(f1.argmax())
    below = out[falling][at + 1] if at + 1 < len(out) else 0.0
    # Half way to the next text, and within bounds, so that neither side sits on the edge.
    threshold = float(np.clip((out[falling][at] + below) / 2, 0.2, 0.8))
    return ToxicityChain(categories, numbers[chosen], tuple(weights), threshold)


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", per_class: int = PER_CLASS
) -> ToxicityChain:
    """Fit on a bounded sample of labelled documents.

    The sample is drawn by a hash of the id, about ``per_class`` of each kind.  An id gives each of its
    texts once and at most ``TEXTS_PER_ID``, those of the smallest hashes.  Labels that are null
    are left out; several labels of one id count as toxic if one is.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("labelled")).agg(F.max("toxic").alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    categories = (*CATEGORY_WORDS, "toxic")
    if not counts.get(0) or not counts.get(1):
        return train([], np.zeros((0, len(categories))), categories)
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("labelled")), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, per_class / counts[1]).otherwise(per_class / counts[0])
    # About 2 * per_class ids, cut off at twice that, so the side is small by construction.
    sample = known.where(draw < share).orderBy(draw, "labelled").limit(4 * per_class)
    rows = docs.select(F.col(id_col).cast("long").alias("labelled"), "text").join(F.broadcast(sample), "labelled")
    rows = rows.withColumn("hash", F.xxhash64("text")).dropDuplicates(["labelled", "hash"])
    place = F.row_number().over(Window.partitionBy("labelled").orderBy("hash"))
    rows = rows.withColumn("place", place).where(F.col("place") <= TEXTS_PER_ID).select("labelled", "toxic", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = SpanHasher()
        for frame in frames:
            words = [set(_OTHERS.split(t.lower())) if isinstance(t, str) else set() for t in frame["text"]]
            yield pd.DataFrame({
                "labelled": frame["labelled"], "toxic": frame["toxic"],
                "bag": [text_features(hasher, t).astype("<i4").tobytes() for t in frame["text"]],
                **{name: [int(not w.isdisjoint(seeds)) for w in words] for name, seeds in CATEGORY_WORDS.items()},
            })

    schema = "labelled long, toxic int, bag binary, " + ", ".join(f"{n} int" for n in CATEGORY_WORDS)
    found = sorted(rows.mapInPandas(run, schema).collect(), key=lambda r: (r["labelled"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], "<i4").astype(np.int64) for r in found]
    marks = np.array([[*(r[n] * r["toxic"] for n in CATEGORY_WORDS), r["toxic"]] for r in found], float)
    return train(bags, marks.reshape(len(found), len(categories)), categories)


def score(docs: DataFrame, chain: ToxicityChain, id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``p_<category>`` for each category and ``toxic``, one row per document.

    The whole text counts.  Null and empty texts and texts without letters have no features and are
    not toxic.  Rows that repeat come out as often as they came in.
    """
    names = [f"p_{c}" for c in chain.categories]
    kinds = ", ".join(f"{n} double" for n in names)

    @F.pandas_udf(f"{kinds}, toxic boolean")
    def judged(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hasher = SpanHasher()
        for texts in parts:
            bags = [text_features(hasher, t) for t in texts]
            chances = np.array([chain.chances(b) for b in bags]).reshape(len(bags), len(names))
            toxic = [len(b) > 0 and p >= chain.threshold for b, p in zip(bags, chances[:, -1])]
            yield pd.DataFrame({**dict(zip(names, chances.T)), "toxic": toxic})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), judged(F.col("text")).alias("judged"))
    return rows.select("doc_id", "judged.*")


def drop_toxic(docs: DataFrame, chain: ToxicityChain) -> DataFrame:
    """The documents that are not toxic, with all their columns."""

    @F.pandas_udf("boolean")
    def stays(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hasher = SpanHasher()
        for texts in parts:
            bags = [text_features(hasher, t) for t in texts]
            yield pd.Series([not (len(b) and chain.chances(b)[-1] >= chain.threshold) for b in bags], dtype=bool)

    return docs.where(stays(F.col("text")))


@query("op8_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
