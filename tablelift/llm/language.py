"""Language of code-switched texts by a linear-chain conditional random field over words.

Each word's label is scored by its affixes, its n-grams and its place in a lexicon, label
pairs by learned transitions, and forward-backward gives each word's label probabilities
given the whole text. A text's language is the one most of its words are expected to be in.
The field is trained on a bounded sample of texts; every text is labelled whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablelift.llm.chains import expectations, marginals
from tablelift.llm.words import LETTER_BYTES, mix, text_chunks, word_hashes, word_spans

# Texts of each language that the field is trained on, about, and code points of one at most,
# unless a language has no text that short.
SAMPLE_TEXTS, SAMPLE_CHARS = 250, 20_000
# Texts in all, about: with very many languages there are fewer of each.
SAMPLE_IN_ALL = 64_000
# Languages at most; every one is a row and a column of the transitions.
MAX_LANGUAGES = 1024
# Slots of features, and of the features of all languages together: more languages share fewer.
SLOTS, SLOTS_IN_ALL = 1 << 16, 1 << 24
AFFIXES = (1, 2, 3)
GRAMS = (3, 4)
# A word is in the lexicon if the sample has it so often.
LEXICON_COUNT = 5
EPOCHS, BATCH_TEXTS, RATE, DECAY = 3, 100, 0.5, 1e-4


def _slot(hashes: np.ndarray, kind: int) -> np.ndarray:
    salt = np.uint64((kind * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    return (mix(hashes ^ salt) >> np.uint64(48)).astype(np.int64)


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: np.ndarray):
    """(feature slots, bounds): those of word i are slots[bounds[i]:bounds[i + 1]]."""
    words = np.arange(len(starts))
    owner, slots = [], []
    for k in AFFIXES:
        owner += [words, words]
        slots.append(_slot(word_hashes(data, starts, np.minimum(starts + k, ends)), k))
        slots.append(_slot(word_hashes(data, np.maximum(ends - k, starts), ends), 10 + k))
    whole = word_hashes(data, starts, ends)
    if len(lexicon):
        known = np.flatnonzero(lexicon[np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)] == whole)
        owner.append(known)
        slots.append(_slot(whole[known], 20))
    for k in GRAMS:
        many = np.maximum(ends - starts - k + 1, 0)
        of = np.repeat(words, many)
        at = starts[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        owner.append(of)
        slots.append(_slot(word_hashes(data, at, at + k), 30 + k))
    owner, slots = np.concatenate(owner), np.concatenate(slots)
    order = np.argsort(owner, kind="stable")
    return slots[order], np.searchsorted(owner[order], np.arange(len(starts) + 1))


@dataclass
class Field:
    """A trained field: a row of label weights for each feature slot, and transitions."""

    languages: list[str]
    lexicon: np.ndarray
    weights: np.ndarray
    start: np.ndarray
    move: np.ndarray

    def scores(self, slots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if len(bounds) == 1:
            return np.zeros((0, len(self.languages)))
        return np.add.reduceat(self.weights[slots & (len(self.weights) - 1)], bounds[:-1], axis=0).astype(np.float64)


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(starts and ends of one place of each distinct word, the distinct word of each word)."""
    _, first, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    return starts[first], ends[first], which


def train(texts: list[str], labels: list[str], seed: int = 7) -> Field | None:
    """A field from texts in one language each; None without any."""
    languages = sorted(set(labels))
    if not languages:
        return None
    y_of = np.array([languages.index(label) for label in labels])
    order = np.random.default_rng(seed).permutation(len(texts))
    joined = pa.array([texts[i] for i in order], pa.large_string())
    chunks = [c for c in text_chunks(joined, limit=1 << 40)]
    _, data, offsets = chunks[0]
    starts, ends, before = word_spans(data, offsets, LETTER_BYTES)
    one_start, one_end, which = distinct_words(data, starts, ends)
    counts = np.bincount(which, minlength=len(one_start))
    frequent = counts >= LEXICON_COUNT
    lexicon = np.sort(word_hashes(data, one_start[frequent], one_end[frequent]))
    slots, bounds = word_features(data, one_start, one_end, lexicon)
    n = len(languages)
    size = min(SLOTS, 1 << (SLOTS_IN_ALL // n).bit_length() - 1)
    slots &= size - 1
    field = Field(languages, lexicon, np.zeros((size, n), np.float32), np.zeros(n), np.zeros((n, n)))
    squares, move_squares, start_squares = np.full((size, n), 1e-6), np.full((n, n), 1e-6), np.full(n, 1e-6)
    y_text = y_of[order]
    for _ in range(EPOCHS):
        for a in range(0, len(texts), BATCH_TEXTS):
            b = min(a + BATCH_TEXTS, len(texts))
            part = before[a : b + 1] - before[a]
            words, local = np.unique(which[before[a] : before[b]], return_inverse=True)
            if not len(words):
                continue
            sizes = bounds[words + 1] - bounds[words]
            own = np.concatenate(([0], np.cumsum(sizes)))
            at = np.arange(own[-1]) - np.repeat(own[:-1], sizes) + np.repeat(bounds[words], sizes)
            scores = field.scores(slots[at], own)[local]
            y = np.repeat(y_text[a:b], np.diff(part))
            single, first, pairs = expectations(scores, part, field.start, field.move)
            single[np.arange(len(y)), y] -= 1
            opened = y_text[a:b][np.diff(part) > 0]
            first -= np.bincount(opened, minlength=n)
            pairs -= np.diag(np.bincount(y, minlength=n) - np.bincount(opened, minlength=n))
            by_word = np.stack([np.bincount(local, single[:, k], len(words)) for k in range(n)], axis=1)
            spread = np.repeat(by_word, sizes, axis=0)
            step = np.stack([np.bincount(slots[at], spread[:, k], size) for k in range(n)], axis=1)
            for value, gradient, square in (
                (field.weights, step / len(y), squares), (field.move, pairs / len(y), move_squares),
                (field.start, first / len(y), start_squares),
            ):
                gradient = gradient + DECAY * value * (gradient != 0)
                square += gradient**2
                value -= RATE * gradient / np.sqrt(square)
    return field


def training_sample(docs: DataFrame, chosen: Column, per_language: int, max_chars: int) -> tuple[list[str], list[str]]:
    """(texts, languages) of about ``per_language`` texts of each language, by a hash of doc_id.

    Languages are those of all chosen rows. Of a language that has texts of ``max_chars``
    code points or fewer only those are taken, of another whole longer ones, about as many
    as make up the same size.
    """
    size = F.length("text")
    usable = docs.where(chosen & F.col("text").isNotNull() & F.col("lang").isNotNull())
    counted = usable.groupBy("lang").agg(
        F.count_if(size <= max_chars).alias("short"), F.count("*").alias("n"), F.avg(size).alias("mean")
    ).limit(MAX_LANGUAGES + 1).collect()
    if len(counted) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counted:
        return [], []
    per_language = max(1, min(per_language, SAMPLE_IN_ALL // len(counted)))
    parts = 1_000_000
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(parts))
    shares, lengths = [], []
    for r in counted:
        wanted, of = (per_language, r.short) if r.short else (max(1, int(per_language * max_chars / r.mean)), r.n)
        shares += [F.lit(r.lang), F.lit(min(parts, -(-parts * wanted // of)))]
        lengths += [F.lit(r.lang), F.lit(max_chars if r.short else 1 << 31)]
    fits = (place < F.create_map(*shares)[F.col("lang")]) & (size <= F.create_map(*lengths)[F.col("lang")])
    rows = usable.where(fits).select("doc_id", "text", "lang").orderBy("doc_id", "text")
    found = rows.limit(2 * per_language * len(counted)).toArrow()
    # By the hash a language may have drawn none of its few texts; then it gets one.
    drawn = set(found["lang"].to_pylist())
    missing = [r.lang for r in counted if r.lang not in drawn]
    if missing:
        one = usable.where(F.col("lang").isin(missing)).groupBy("lang").agg(
            F.min_by("text", F.struct(size, F.col("text"))).alias("text")
        ).select("text", "lang").toArrow()
        return found["text"].to_pylist() + one["text"].to_pylist(), found["lang"].to_pylist() + one["lang"].to_pylist()
    return found["text"].to_pylist(), found["lang"].to_pylist()


def language(
    docs: DataFrame, trained_on: Column, per_language: int = SAMPLE_TEXTS, max_chars: int = SAMPLE_CHARS
) -> DataFrame:
    """doc_id, lang_pred, score, n_words, shares: one row for each row of ``docs``.

    The field is trained on rows for which ``trained_on`` holds and text and lang are not
    null. ``shares`` maps each language to the expected share of the text's words in it,
    lang_pred is the language of the largest, which is the score; ties go to the first by
    name. A text that is null or has no letter is ``und`` with score 0 and null shares, and
    so is every text if there is nothing to train on.

    Rows with equal or null ids are labelled each by its text; an empty table gives an
    empty result. Nothing but the text is seen when a row is labelled.
    """
    field = train(*training_sample(docs, trained_on, per_language, max_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                rows = len(offsets) - 1
                starts, ends, before = word_spans(data, offsets, LETTER_BYTES)
                counts = np.diff(before)
                names: list[str | None] = ["und"] * rows
                best, shares = np.zeros(rows), [None] * rows
                if field and len(starts):
                    one_start, one_end, which = distinct_words(data, starts, ends)
                    scores = field.scores(*word_features(data, one_start, one_end, field.lexicon))
                    found = marginals(scores[which], before, field.start, field.move)
                    sums = np.concatenate((np.zeros((1, found.shape[1])), np.cumsum(found, axis=0)))
                    mean = np.clip((sums[before[1:]] - sums[before[:-1]]) / np.maximum(counts, 1)[:, None], 0, 1)
                    # Bytes of longer characters may be no letters; texts of them alone are looked at.
                    plain = np.concatenate(([0], np.cumsum(LETTER_BYTES[data] & (data < 128))))[offsets]
                    for i in np.flatnonzero(counts):
                        if plain[i + 1] > plain[i] or any(
                            c.isalpha() for c in bytes(data[offsets[i] : offsets[i + 1]]).decode()
                        ):
                            k = int(mean[i].argmax())
                            names[i], best[i] = field.languages[k], mean[i, k]
                            shares[i] = list(zip(field.languages, mean[i].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(names, pa.string()), pa.array(best),
                     pa.array(counts, pa.int64()), pa.array(shares, pa.map_(pa.string(), pa.float64()))],
                    names=["doc_id", "lang_pred", "score", "n_words", "shares"],
                )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(
        run, "doc_id long, lang_pred string, score double, n_words long, shares map<string, double>"
    )
