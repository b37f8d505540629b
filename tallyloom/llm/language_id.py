"""Language identification by averaged hashed subwords.

Runs of three and four bytes of the lower-cased letters are hashed to rows of an embedding table; a
text is the mean of its rows, and a linear softmax names its language.  Table and softmax are
trained together by stochastic gradient descent in numpy, on at most ``PER_LANGUAGE`` labelled
texts of each language.  A temperature fitted on texts kept back calibrates the probability, and a
text is rejected below the probability at which the texts kept back reach the wanted precision.

The trained tables multiply out to one row of logits per bucket, a few MB at most, which goes to
the tasks with the function that scores whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.llm.registry import query, table

BUCKET_BITS = 14
DIM = 16
PER_LANGUAGE = 600
EPOCHS = 6
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_OTHERS = re.compile(r"[\W\d_]+")


def subwords(text: str) -> np.ndarray:
    """Buckets of all runs of three and four bytes, words parted by one space."""
    data = f" {_OTHERS.sub(' ', text.lower()).strip()} ".encode("utf-8", "surrogatepass")
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    three = b[:-2] * np.uint32(961748941) + b[1:-1] * np.uint32(49979693) + b[2:] * np.uint32(15485863)
    four = three[:-1] * np.uint32(31) + b[3:] * np.uint32(2038074743)
    grams = np.concatenate([three, four])
    return ((grams ^ (grams >> np.uint32(15))) * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    logits: np.ndarray  # one row per bucket, temperature included
    bias: np.ndarray
    accept: float

    def probabilities(self, text: str) -> np.ndarray:
        z = self.logits[subwords(text)].mean(axis=0) + self.bias
        e = np.exp(z - z.max())
        return e / e.sum()


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], names: list[str], precision: float = 0.98, seed: int = 5) -> LanguageModel:
    """Fit on all but every tenth text; those set the temperature and the rejection bound."""
    languages = tuple(sorted(set(names)))
    if not languages:
        return LanguageModel((), np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros(0), 0.0)
    place = {name: i for i, name in enumerate(languages)}
    goal = np.array([place[n] for n in names])
    bags = [np.unique(subwords(t), return_counts=True) for t in texts]
    rng = np.random.default_rng(seed)
    table_ = rng.normal(0, 1 / DIM, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    order = rng.permutation(len(bags))
    kept, fitted = order[::10], np.array([i for k, i in enumerate(order) if k % 10]) if len(order) > 1 else order
    for epoch in range(EPOCHS):
        for i in rng.permutation(fitted):
            rows, counts = bags[i]
            share = (counts / counts.sum()).astype(np.float32)
            mean = share @ table_[rows]
            wrong = _softmax((mean @ out + bias)[None])[0].astype(np.float32)
            wrong[goal[i]] -= 1
            rate = np.float32(2.0 * (1 - epoch / EPOCHS))
            back = out @ wrong
            out -= rate * np.outer(mean, wrong)
            bias -= np.float32(0.1) * rate * wrong
            # Common subwords hold most of the mean, so each row moves by the root of its share.
            table_[rows] -= rate * np.sqrt(share)[:, None] * back[None]
    flat = table_ @ out
    held = np.array([(c / c.sum()) @ flat[r] for r, c in (bags[i] for i in kept)]) + bias
    truth = goal[kept]
    loss = lambda scale: -np.log(_softmax(held * scale)[np.arange(len(truth)), truth] + 1e-12).mean()
    scale = min((2.0 ** p for p in np.arange(-4, 5, 0.5)), key=loss)
    chances = _softmax(held * scale)
    best = chances.max(axis=1)
    right = chances.argmax(axis=1) == truth
    falling = np.argsort(-best)
    exact = np.cumsum(right[falling]) / np.arange(1, len(right) + 1)
    enough = np.flatnonzero(exact >= precision)
    accept = float(best[falling][enough[-1]]) if len(enough) else 1.0
    return LanguageModel(languages, (flat * scale).astype(np.float32), bias * scale, accept)


def held_out(id_: Column, parts: int = 4, part: int = 2) -> Column:
    """True for the fold that training never sees; null ids are never trained on."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % parts == part, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fit on labelled texts with letters outside the held-out fold, about ``per_language`` each.

    The sample is drawn by a hash of the id: a language with n texts keeps each with the chance
    ``per_language`` / n.  Only this sample reaches the driver.
    """
    id_ = F.col(id_col)
    rows = docs.where(id_.isNotNull() & F.col("lang").isNotNull() & ~held_out(id_) & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return train([], [])
    draw = F.pmod(F.xxhash64(F.lit("language"), id_), F.lit(1 << 30)) / float(1 << 30)
    shares = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, per_language / n)])
    sample = (
        rows.where(draw < F.element_at(shares, F.col("lang"))).select(id_.alias("id"), "lang", "text")
        .orderBy("id", "text").limit(2 * per_language * len(counts)).collect()
    )
    return train([r["text"] for r in sample], [r["lang"] for r in sample])


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, lang_pred, score, rejected``, one row per document, from the whole text alone.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text if nothing
    could be learned.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def named(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            found = []
            for text in texts:
                if not model.languages or not has_letter(text):
                    found.append((UNKNOWN, 0.0, True))
                    continue
                p = model.probabilities(text)
                found.append((model.languages[int(p.argmax())], float(p.max()), bool(p.max() < model.accept)))
            yield pd.DataFrame(found, columns=["lang_pred", "score", "rejected"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
        named(F.col("text")).alias("named"),
    )
    return rows.select("doc_id", "held_out", "named.*")


@query("op9_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
