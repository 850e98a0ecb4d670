"""Toxicity by non-negative positive-unlabelled learning, in numpy, over words and their stems."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, small_batches, texts_of
from tidemark.session import shuffled, stage

#: Texts that the classifier is fitted on, at most about: confirmed toxic ones, and any ones.
POSITIVE, UNLABELLED = 4096, 8192
#: Words and stems that it may look at, at most.
FEATURES = 4096
_STEMS = (4, 5, 6)
_HALF = 4.0  # the gain of a feature whose weight counts half; the best gain, if that is less
_COUNTED = 1 << 17  # features that a task counts before it sends them on
_WORD = re.compile(r"[^\W\d_]+")
_CACHE = 1 << 18


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    weights: np.ndarray
    bias: float


def _stems(word: str) -> list[str]:
    """The beginnings of a word, with a mark that no word has."""
    return [f"{word[:n]}*" for n in _STEMS if len(word) > n]


def _length(words: set[str]) -> str:
    return f"#{len(words).bit_length()}"


def _features(words: set[str]) -> set[str]:
    """The words, their stems, stems of several words, and how many words there are, by powers of
    two: a long text has many of the words that toxic ones have, without being toxic."""
    stems = Counter(s for w in words for s in _stems(w))
    return {*words, *stems, *(f"{s}*" for s, n in stems.items() if n > 1), _length(words)}


def _words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows whose labels are never learnt from; a null id has no remainder and is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def _lowest(ids: DataFrame, n: int) -> DataFrame:
    """A fixed draw of at most n of the distinct ids, spread by hash."""
    return ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    positive: int = POSITIVE,
    unlabelled: int = UNLABELLED,
    features: int = FEATURES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model | None:
    """A linear classifier; None if no text is confirmed toxic.

    Labels are read only where `held_out` is false: the confirmed toxic ids, of which at most
    `positive` are used, and the share of toxic ones among labelled rows, the class prior. The
    unlabelled texts are those of the same part whatever their labels. How often a feature stands
    in them is counted over all; the steps see a draw of at most `unlabelled`. Of rows that share
    a drawn id one is used. Both draws and the features are bounded by parameters, so the driver's
    work is too.
    """
    texts = texts_of(docs, id_col, text_col).where(~held_out(F.col("doc_id")))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        ~held_out(F.col("doc_id")) & F.col("toxic").isNotNull()
    )
    prior = known.agg(F.avg("toxic")).first()[0]
    if not prior:
        return None
    toxic = _lowest(known.where("toxic = 1").select("doc_id"), positive)
    drawn = _lowest(texts.select("doc_id"), unlabelled)
    wanted = (
        toxic.withColumn("p", F.lit(1))
        .unionByName(drawn.withColumn("p", F.lit(0)))
        .groupBy("doc_id")
        .agg(F.max("p").alias("is_p"), (F.min("p") == 0).alias("is_u"))
    )
    # at most positive + unlabelled rows: of an id that repeats, the smallest text
    sample = stage(
        texts.join(F.broadcast(wanted), "doc_id")
        .groupBy("doc_id", "is_p", "is_u")
        .agg(F.min("text").alias("text"))
        .select("text", "is_p", "is_u"),
        "sample",
    )
    chosen = _choose(sample, texts, features)
    if not chosen:
        return None
    names = tuple(chosen)
    rows = _encode(sample, names).collect()
    return _learn(names, rows, min(float(prior), 0.999), np.array([chosen[n] for n in names]))


def _counted(texts: DataFrame, name: str) -> DataFrame:
    """(name, number of texts that have it) of every feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def told() -> pa.RecordBatch:
            columns = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["name", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(_features(_words(text)))
                if len(found) >= _COUNTED:
                    yield told()
                    found.clear()
        if found:
            yield told()

    each = texts.select("text").mapInArrow(run, "name string, n long")
    return each.groupBy("name").agg(F.sum("n").alias(name))


def _choose(sample: DataFrame, texts: DataFrame, features: int) -> dict[str, float]:
    """The features that confirmed texts have more often than any texts, and how much the weight
    of each counts, from 0 to 1: the more, the less it can be by chance. No number of texts is too
    small for a feature; what stands in one or two counts little beside what stands in many."""
    in_p, in_u = _counted(sample.where("is_p = 1"), "n_p"), _counted(texts, "n_u")
    n_p, n_u = sample.where("is_p = 1").count(), texts.count()
    if not n_p or not n_u:
        return {}
    # how many confirmed texts would have it, were they like any texts
    expected = n_p * (F.coalesce("n_u", F.lit(0)) + 0.5) / n_u
    chosen = (
        in_p.join(shuffled(in_u), "name", "left")
        .withColumn("gain", (F.col("n_p") - expected) / F.sqrt(expected + 1))
        .where("gain > 0 AND name NOT LIKE '#%'")
        .orderBy(F.desc("gain"), "name")
        .limit(features)
    )
    gains = {r.name: r.gain for r in chosen.select("name", "gain").collect()}
    half = min(_HALF, max(gains.values(), default=_HALF))
    counts = {n: gains[n] ** 4 / (gains[n] ** 4 + half**4) for n in sorted(gains)}
    return {**counts, **{f"#{n}": 1.0 for n in range(33)}} if counts else {}


def _encode(sample: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The chosen features of each text, as numbers."""
    number = {n: i for i, n in enumerate(names)}

    def work(batch: dict[str, list]) -> dict[str, list]:
        found = []
        for text in batch["text"]:
            found.append(sorted(number[f] for f in _features(_words(text)) if f in number))
        return {"on": found, "is_p": batch["is_p"], "is_u": batch["is_u"]}

    return map_batches(sample, work, "on array<int>, is_p int, is_u boolean").orderBy("is_p", "is_u", "on")


class _Rows:
    """Rows of features that are on, as one array with ends; a column of ones is the bias."""

    def __init__(self, rows: list[list[int]], width: int) -> None:
        self.count = np.array([len(r) for r in rows])
        self.on = np.array([i for r in rows for i in r], dtype=np.int64)
        self.row = np.repeat(np.arange(len(rows)), self.count)
        self.width = width

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.row, weights=weights[self.on], minlength=len(self.count)) + bias

    def gradient(self, by_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.on, weights=by_row[self.row], minlength=self.width)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _learn(
    names: tuple[str, ...],
    rows: list,
    prior: float,
    counts: np.ndarray | None = None,
    steps: int = 400,
    rate: float = 0.05,
    decay: float = 1e-4,
) -> Model:
    """Gradient steps (Adam) on the non-negative risk, with the logistic loss l:

    prior * E_p l(f) + max(0, E_u l(-f) - prior * E_p l(-f))

    The second part estimates the risk on clean texts from unlabelled ones, less what toxic ones
    among them must cause. Where it falls below zero, the step goes back up on it alone.
    A feature's weight counts as much as `counts` says, all of it without.
    """
    counts = np.ones(len(names)) if counts is None else counts
    p = _Rows([r.on for r in rows if r.is_p], len(names))
    u = _Rows([r.on for r in rows if r.is_u], len(names))
    weights, bias = np.zeros(len(names)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    length = np.array([n.startswith("#") for n in names])
    for step in range(1, steps + 1):
        at_p, at_u = p.scores(weights * counts, bias), u.scores(weights * counts, bias)
        n_p, n_u = len(at_p), len(at_u)
        clean = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
        # slopes of l(f) and l(-f) in f
        down_p, up_p, up_u = -_sigmoid(-at_p), _sigmoid(at_p), _sigmoid(at_u)
        if clean >= 0:
            by_p, by_u = prior * (down_p - up_p) / n_p, up_u / n_u
        else:
            by_p, by_u = prior * up_p / n_p, -up_u / n_u
        slope = np.append(counts * (p.gradient(by_p) + u.gradient(by_u)) + decay * weights, by_p.sum() + by_u.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - change[:-1], bias - float(change[-1])
        weights[length] = np.minimum(weights[length], 0)  # length alone is no sign of toxicity
    return Model(names, weights * counts, bias)


class _Scorer:
    """What the model looks at in a word, remembered from word to word."""

    def __init__(self, model: Model) -> None:
        self.bias = model.bias
        self.weight = dict(zip(model.names, model.weights.tolist(), strict=True))
        self.of_word: dict[str, tuple[str, ...]] = {}

    def _watched(self, word: str) -> tuple[str, ...]:
        found = self.of_word.get(word)
        if found is None:
            if len(self.of_word) >= _CACHE:
                self.of_word.clear()
            stems = [s for s in _stems(word) if s in self.weight or f"{s}*" in self.weight]
            found = self.of_word[word] = (*([word] if word in self.weight else []), *stems)
        return found

    def score(self, text: str | None) -> float:
        words = _words(text)
        seen = Counter(f for word in words for f in self._watched(word))
        on = {*seen, *(f"{f}*" for f, n in seen.items() if n > 1), _length(words)}
        total = self.bias + sum(self.weight.get(f, 0.0) for f in sorted(on))
        return float(_sigmoid(np.float64(total)))


def score(self, text: str | None) -> float:
        on: set[int] = set()
        for word in _words(text):
            found = self.of_word.get(word)
            if found is None:
                if len(self.of_word) >= _CACHE:
                    self.of_word.clear()
                found = self.of_word[word] = tuple(self.number[f] for f in _features(word) if f in self.number)
            if found:
                on.update(found)
        return float(_sigmoid(np.float64(self.model.bias + sum(self.model.weights[i] for i in sorted(on)))))


def score(docs: DataFrame, model: Model | None, name: str = "score", text_col: str = "text") -> DataFrame:
    """`docs` with a column `name`: how likely the whole text is toxic, from 0 to 1.

    One pass without an exchange, a row in, a row out. A null or empty text, and one without any
    of the model's features, gets what the bias alone says; without a model all get 0.
    """
    own = [F.col(f"`{c}`") for c in small_batches(docs).columns]
    if model is None:
        return docs.select(*own, F.lit(0.0).alias(name))
    scorer: list[_Scorer] = []

    def scored(texts: pd.Series) -> pd.Series:
        if not scorer:
            scorer.append(_Scorer(model))
        return pd.Series([scorer[0].score(t) for t in texts], dtype="float64")

    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(*own, F.pandas_udf(scored, "double")(text).alias(name))
