"""Toxicity by a chain of linear classifiers.

Each category has a logistic model over the words of a text and a few shares of its
characters. The categories stand in an order, and a later model also gets the log odds
that the earlier ones gave. It is trained with out-of-fold odds, so it learns what those
are worth on texts their models have not seen. Models are fitted on a bounded sample of
labelled documents; every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tablelift.llm.words import (
    CAPITAL_BYTES, LETTER_BYTES, WORD_BYTES, distinct, text_chunks, word_hashes, word_spans,
)

# Labelled documents that models are fitted on, about; below that, all.
SAMPLE_ROWS = 12_000
# Words of one model at most, those that tell its classes apart best.
MODEL_WORDS = 512
FOLDS = 3
RIDGE = 1.0
SHARES = 4
# Rows that are spread out as numbers at a time when a model is fitted.
FIT_ROWS = 1024


def text_features(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """(first row, sorted hashes of each text's distinct words, its character shares)."""
    for first, data, offsets in text_chunks(texts):
        starts, ends, before = word_spans(data, offsets, LETTER_BYTES)
        hashes = word_hashes(data, starts, ends)
        words = [distinct(hashes[a:b]) for a, b in zip(before[:-1], before[1:])]

        def share(members: np.ndarray, of: np.ndarray) -> np.ndarray:
            counts = np.diff(np.concatenate(([0], np.cumsum(members[data])))[offsets])
            return counts / np.maximum(of, 1)

        size = np.diff(offsets)
        shares = np.stack(
            [
                share(WORD_BYTES & ~LETTER_BYTES, size),
                share(CAPITAL_BYTES, size),
                np.array([len(w) for w in words]) / np.maximum(np.diff(before), 1),
                np.log1p(np.diff(before)) / 10,
            ],
            axis=1,
        )
        yield first, words, shares


def _presence(docs: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """A row of bytes for each document with a one for each chosen word in it."""
    out = np.zeros((len(docs), len(chosen)), np.uint8)
    if len(chosen):
        words = np.concatenate(docs) if docs else np.zeros(0, np.uint64)
        rows = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        places = np.minimum(np.searchsorted(chosen, words), len(chosen) - 1)
        hit = chosen[places] == words
        out[rows[hit], places[hit]] = 1
    return out


def _telling_words(docs: list[np.ndarray], y: np.ndarray, limit: int) -> np.ndarray:
    """Words whose presence depends on the class, by a G-test corrected for their number."""
    words, doc_of = np.concatenate(docs), np.repeat(y, [len(d) for d in docs])
    vocabulary, place = np.unique(words, return_inverse=True)
    n, n1 = len(y), y.sum()
    have = np.bincount(place, minlength=len(vocabulary)).astype(float)
    have1 = np.bincount(place, weights=doc_of, minlength=len(vocabulary))

    def term(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    g = 2 * (
        term(have1, have * n1 / n) + term(have - have1, have * (n - n1) / n)
        + term(n1 - have1, (n - have) * n1 / n) + term(n - n1 - have + have1, (n - have) * (n - n1) / n)
    )
    good = np.flatnonzero(g > 2 * np.log(max(len(vocabulary), 1)) + 10)
    good = good[np.argsort(-g[good], kind="stable")[:limit]]
    return np.sort(vocabulary[good])


def _fit(present: np.ndarray, shares: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights of a logistic model, the constant last, by Newton steps.

    Sums over rows are taken block by block, so that only bytes are held for all of them.
    """
    size = present.shape[1] + shares.shape[1] + 1
    w = np.zeros(size)
    penalty = np.full(size, ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        curve, slope = np.diag(penalty), -penalty * w
        for a in range(0, len(y), FIT_ROWS):
            rows = slice(a, a + FIT_ROWS)
            x = np.hstack([present[rows], shares[rows], np.ones((len(y[rows]), 1))])
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            curve += (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x
            slope += x.T @ (y[rows] - p)
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


@dataclass
class Link:
    """One category's model: chosen words, then shares, then earlier odds, then a constant."""

    words: np.ndarray
    weights: np.ndarray
    threshold: float = 0.0

    def odds(self, docs: list[np.ndarray], shares: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        present, other = _presence(docs, self.words), np.hstack([shares, earlier])
        k = present.shape[1]
        return np.clip(present @ self.weights[:k] + other @ self.weights[k:-1] + self.weights[-1], -15, 15)


def _link(docs, shares, earlier, y, ridge, limit) -> Link:
    words = _telling_words(docs, y, limit) if 0 < y.sum() < len(y) else np.zeros(0, np.uint64)
    return Link(words, _fit(_presence(docs, words), np.hstack([shares, earlier]), y, ridge))


def _threshold(odds: np.ndarray, y: np.ndarray) -> float:
    """Odds above which a document is rejected: best F0.5, midway to the next document.

    F0.5 counts a clean document that is lost for more than a toxic one that stays.
    """
    if not 0 < y.sum() < len(y):
        return float("inf")
    order = np.argsort(-odds, kind="stable")
    odds, y = odds[order], y[order]
    hits = np.cumsum(y)
    score = 1.25 * hits / (np.arange(1, len(y) + 1) + 0.25 * y.sum())
    score[:-1][odds[:-1] == odds[1:]] = 0
    best = int(np.argmax(score))
    return float((odds[best] + odds[best + 1]) / 2) if best + 1 < len(odds) else float(odds[best]) - 1


def fit_chain(
    docs: list[np.ndarray], shares: np.ndarray, labels: np.ndarray, folds: np.ndarray,
    ridge: float = RIDGE, limit: int = MODEL_WORDS,
) -> list[Link]:
    """One model for each column of ``labels``, each fed with the ones before."""
    chain: list[Link] = []
    earlier = np.zeros((len(docs), 0))
    for y in labels.T.astype(float):
        unseen = np.zeros(len(docs))
        for fold in np.unique(folds):
            out, rest = np.flatnonzero(folds == fold), np.flatnonzero(folds != fold)
            if not len(rest):
                continue
            part = _link([docs[i] for i in rest], shares[rest], earlier[rest], y[rest], ridge, limit)
            unseen[out] = part.odds([docs[i] for i in out], shares[out], earlier[out])
        link = _link(docs, shares, earlier, y, ridge, limit)
        link.threshold = _threshold(unseen, y)
        chain.append(link)
        earlier = np.hstack([earlier, unseen[:, None]])
    return chain


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: dict[str, str], rows: int) -> DataFrame:
    """text, fold and a 0/1 column for each category, of about ``rows`` labelled documents.

    The choice is by a hash of doc_id; labels that lack an id or a category are left out, and
    of several for one document the highest counts.
    """
    marks = labels.select("doc_id", *(F.expr(sql).cast("int").alias(c) for c, sql in categories.items()))
    marks = marks.dropna().groupBy("doc_id").agg(*(F.max(c).alias(c) for c in categories))
    share = min(1.0, rows / max(marks.count(), 1))
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000))
    chosen = marks.where(place < int(share * 1_000_000)).limit(2 * rows)
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # At most 2 * rows short rows are sent to every task.
    return texts.join(F.broadcast(chosen), "doc_id").select("text", fold, *categories)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str], sample_rows: int = SAMPLE_ROWS
) -> list[Link]:
    """The chain for ``categories``, name to SQL over a label row, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, shares in text_features(batch.column(0)):
                part = batch.slice(first, len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.tobytes() for w in words], pa.binary()),
                     pa.array([s.tobytes() for s in shares], pa.binary()), *part.columns[1:]],
                    names=["words", "shares", "fold", *categories],
                )

    sample = labelled_sample(docs, labels, categories, sample_rows)
    schema = "words binary, shares binary, fold int, " + ", ".join(f"{c} int" for c in categories)
    found = sample.mapInArrow(run, schema).toArrow().sort_by([("words", "ascending"), ("shares", "ascending")])
    if not found.num_rows:
        empty = Link(np.zeros(0, np.uint64), np.zeros(0), float("inf"))
        return [Link(empty.words, np.zeros(SHARES + i + 1), float("inf")) for i in range(len(categories))]
    words = [np.frombuffer(w, np.uint64) for w in found["words"].to_pylist()]
    shares = np.array([np.frombuffer(s, np.float64) for s in found["shares"].to_pylist()])
    marks = np.stack([found[c].to_numpy() for c in categories], axis=1)
    return fit_chain(words, shares, marks, found["fold"].to_numpy())


CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}


def _with_odds(rows: DataFrame, chain: list[Link], names: list[str]) -> DataFrame:
    """``rows``, whose last column is the text, with the chain's probabilities and verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, shares in text_features(batch.column(batch.num_columns - 1)):
                odds = np.zeros((len(words), 0))
                for link in chain:
                    odds = np.hstack([odds, link.odds(words, shares, odds)[:, None]])
                toxic = odds[:, -1] > chain[-1].threshold
                part = batch.slice(first, len(words))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(1 / (1 + np.exp(-c))) for c in odds.T), pa.array(toxic)],
                    names=[*part.schema.names, *names, "toxic"],
                )

    schema = T.StructType(list(rows.schema.fields))
    for name in names:
        schema = schema.add(name, "double")
    return rows.mapInArrow(run, schema.add("toxic", "boolean"))


def toxicity_of(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """All rows and columns of ``docs`` with p_<category> for each category, and toxic.

    ``toxic`` tells whether the last category's odds are above the threshold that did best
    on out-of-fold odds. Columns of ``docs`` with those names are replaced.

    A null text counts as an empty one; it gets probabilities from its (lacking) words like
    any other. Without labels of both classes nothing is toxic. Rows with equal or null ids
    are scored each by its text, and an empty table gives an empty result.
    """
    chain = fit_toxicity(docs, labels, categories, sample_rows)
    names = [f"p_{c}" for c in categories]
    keep = [c for c in docs.columns if c not in (*names, "toxic")]
    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    return _with_odds(rows, chain, names).drop("__text")


def toxicity(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """doc_id, p_<category> for each category, toxic, kept: ``toxicity_of`` without texts."""
    chain = fit_toxicity(docs, labels, categories, sample_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("__text"))
    found = _with_odds(rows, chain, [f"p_{c}" for c in categories]).drop("__text")
    return found.withColumn("kept", ~F.col("toxic"))
