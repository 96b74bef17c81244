"""Trained models against plain versions of themselves, and the pipeline on odd tables."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelift.llm import lattice, lm_scoring, quality_model, toxicity
from tablelift.llm.language import language, training_sample
from tablelift.llm.near_duplicates import bands_for, near_duplicates
from tablelift.llm.queries import id_part

from .conftest import frame, path_of
from .test_near_duplicates import edited, shingles

PIECES = "piece_bpe_32k.model"


def kneser_ney(texts):
    """p(class | three classes before it), by the textbook; as a function."""
    order = quality_model.ORDER
    counts = [Counter() for _ in range(order + 1)]
    for text in texts:
        stream = [0] * (order - 1) + quality_model.classes_of(text).tolist() + [0]
        for i in range(order - 1, len(stream)):
            counts[order][tuple(stream[i - order + 1 : i + 1])] += 1
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(gram[1:] for gram in counts[n + 1])

    def discounts(c):
        n = [0, *(sum(v == k for v in c.values()) for k in (1, 2, 3, 4))]
        y = n[1] / max(n[1] + 2 * n[2], 1)
        return [
            min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.1), k - 0.1) if n[k] and n[k + 1] else 0.5 * k for k in (1, 2, 3)
        ]

    off = [None, *(discounts(counts[n]) for n in range(1, order + 1))]
    total, taken = [defaultdict(float) for _ in range(order + 1)], [defaultdict(float) for _ in range(order + 1)]
    for n in range(1, order + 1):
        for gram, c in counts[n].items():
            total[n][gram[:-1]] += c
            taken[n][gram[:-1]] += off[n][min(c, 3) - 1]

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / quality_model.CLASSES
        context = gram[:-1]
        lower = p(gram[1:])
        if not total[n][context]:
            return lower
        c = counts[n][gram]
        own = (c - off[n][min(c, 3) - 1]) / total[n][context] if c else 0
        return own + taken[n][context] / total[n][context] * lower

    return p


def test_perplexities_match_a_plain_kneser_ney(spark):
    rng = random.Random(1)
    words = ["der", "Hund", "und", "die", "Katze", "läuft", "42", "ja!", "no."]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    p = kneser_ney(texts)
    scored = ["der Hund", "xyz #", "", None, "die die die die", "läuft 42 no."]
    model = quality_model.fit(quality_model.gram_counts(frame(spark, texts)))
    found = {r.doc_id: r.perplexity for r in quality_model.perplexities(frame(spark, scored), model).collect()}
    for i, text in enumerate(scored):
        stream = [0, 0, 0] + quality_model.classes_of(text or "").tolist() + [0]
        logs = [math.log2(p(tuple(stream[k - 3 : k + 1]))) for k in range(3, len(stream))]
        assert abs(found[i] / 2 ** (-sum(logs) / len(logs)) - 1) < 1e-4, text


def test_document_scores_sum_over_all_segmentations(spark):
    texts = ["The cat sat.", "a cat", None, "übel 中 the THE", "x" * 30, "", "sat sat cat"]
    docs = frame(spark, texts)
    path = path_of(PIECES)
    found = {r.doc_id: r.score for r in lm_scoring.lm_scores(docs, id_part(5) == 1, path, rounds=2).collect()}
    vocabulary, logs = lm_scoring.load_vocabulary(path)
    marked = docs.select("text", (id_part(5) != 1).alias("trains"))
    words = lm_scoring.word_counts(marked).cache()
    logs = lm_scoring.fit_pieces(words, vocabulary, logs, docs.where(id_part(5) != 1).count(), 2)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not model.is_byte(i) and not model.is_control(i)}
    single = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]

    def chance(word):
        """The sum over all segmentations, character by character."""
        spelled = lattice.SPACE + word
        sums = [1.0] + [0.0] * len(spelled)
        for end in range(1, len(spelled) + 1):
            for start in range(end):
                piece = spelled[start:end]
                if piece in ids and piece != "<unk>":
                    sums[end] += sums[start] * math.exp(logs[ids[piece]])
                elif end - start == 1:
                    sums[end] += sums[start] * math.exp(sum(logs[single[b]] for b in piece.encode()))
        return sums[-1]

    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    for i, text in enumerate(texts):
        own = (text or "").translate(lower).split()
        wanted = (sum(math.log(chance(w)) for w in own) + logs[vocabulary.end]) / math.log(10)
        assert abs(found[i] - wanted) < 1e-6 * max(1, abs(wanted)), text


def test_a_vocabulary_with_more_pieces_than_places():
    rng = random.Random(2)
    pieces = list({"".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(150_000)})[:80_000]
    vocabulary = lattice.Vocabulary([*pieces, *[""] * 256], list(range(len(pieces), len(pieces) + 256)), 0)
    assert len(vocabulary.left)
    keys = np.array([vocabulary._key(p) for p in pieces[::97]] + [vocabulary._key("zz" + p) for p in pieces[:50]], np.uint64)
    wanted = [*range(0, len(pieces), 97), *[vocabulary.size] * 50]
    assert vocabulary.find(keys).tolist() == wanted


def plain_chain(docs, shares, labels, folds):
    """Out-of-fold odds of each category, fed to the next, with whole matrices of numbers."""

    def fit(x, y):
        w, penalty = np.zeros(x.shape[1]), np.append(np.ones(x.shape[1] - 1), 1e-6)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-6)) @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
            w += step
            if np.abs(step).max() < 1e-4:
                break
        return w

    def design(some, words, earlier):
        has = np.array([[w in set(docs[i].tolist()) for w in words.tolist()] for i in some], float).reshape(len(some), len(words))
        return np.hstack([has, shares[some], earlier[some], np.ones((len(some), 1))])

    earlier, found = np.zeros((len(docs), 0)), []
    for y in labels.T.astype(float):
        odds = np.zeros(len(docs))
        for fold in range(3):
            out, rest = np.flatnonzero(folds == fold), np.flatnonzero(folds != fold)
            words = toxicity._telling_words([docs[i] for i in rest], y[rest], toxicity.MODEL_WORDS)
            odds[out] = np.clip(design(out, words, earlier) @ fit(design(rest, words, earlier), y[rest]), -15, 15)
        everyone = np.arange(len(docs))
        words = toxicity._telling_words(docs, y, toxicity.MODEL_WORDS)
        found.append((words, fit(design(everyone, words, earlier), y), odds))
        earlier = np.hstack([earlier, odds[:, None]])
    return found


def test_the_chain_matches_whole_matrices():
    rng = np.random.default_rng(3)
    docs = [np.unique(rng.integers(0, 300, 25).astype(np.uint64)) for _ in range(2500)]
    first = np.array([(5 in d) or (9 in d and rng.random() < 0.7) for d in docs], int)
    second = np.array([f and (7 in d or rng.random() < 0.5) for f, d in zip(first, docs)], int)
    labels, shares = np.stack([first, second], axis=1), rng.random((2500, toxicity.SHARES))
    folds = rng.integers(0, 3, 2500)
    chain = toxicity.fit_chain(docs, shares, labels, folds)
    for link, (words, weights, odds), y in zip(chain, plain_chain(docs, shares, labels, folds), labels.T):
        assert (link.words == words).all() and np.allclose(link.weights, weights, atol=1e-5)
        assert abs(link.threshold - toxicity._threshold(odds, y)) < 1e-5
    assert len(chain[1].weights) == len(chain[1].words) + toxicity.SHARES + 1 + 1


def test_links_below_seventy_percent(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        texts += [" ".join(edited(rng, base, rng.randrange(12))) for _ in range(6)]
    sets = [shingles(t) for t in texts]
    found = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, texts), percent=50).collect()}
    least = list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            for j in range(len(texts)):
                both = len(sets[i] & sets[j])
                if 100 * both >= 50 * (len(sets[i]) + len(sets[j]) - both):
                    least[i] = min(least[i], least[j])
    assert found == dict(enumerate(least)) and bands_for(50) > 500


def test_a_language_of_long_texts_alone_is_learnt(spark):
    de, en = "der hund und die katze gehen nach hause", "the dog and the cat walk home again"
    texts = [f"{de} " * 30] * 8 + [en] * 40 + [de, en]
    docs = frame(spark, texts, lang=["de"] * 8 + ["en"] * 40 + [None, None])
    sample = training_sample(docs, F.col("doc_id") < 48, 250, 200)
    assert set(sample[1]) == {"de", "en"} and min(len(t) for t, l in zip(*sample) if l == "de") > 200
    rows = {r.doc_id: r.lang_pred for r in language(docs, F.col("doc_id") < 48, max_chars=200).collect()}
    assert (rows[48], rows[49]) == ("de", "en")


def test_more_than_256_languages(spark):
    names = [a + b for a in "bcdfghjklmnpqrst" for b in "bcdfghjklmnpqrstv"][:260]
    docs = frame(spark, [f"{n}ar o{n}e u{n}" for n in names] * 5, lang=names * 5)
    found = language(docs, F.col("doc_id") < 4 * 260).where(F.col("doc_id") >= 4 * 260)
    right = found.join(docs.select("doc_id", "lang"), "doc_id").where("lang = lang_pred").count()
    assert right > 200


def test_pipeline_stages_on_odd_rows(spark, odd, no_rows, labels, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    path_of(corpus_pipeline.WORD_VOCABULARY)
    # Five labelled rows teach nothing; without any, nothing is toxic.
    labels.where("false").write.parquet(str(tmp_path / "labels.parquet"))
    for start in (odd, no_rows):
        docs, rows = start, start.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            out.write.parquet(str(tmp_path / f"{name}-{rows}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}-{rows}"))
            assert docs.where("toxic <> 'x' OR slot <> 'x' OR hash <> 'x'").count() == 0, name
        pieces = corpus_pipeline.packed(spark, docs, str(tmp_path))
        assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
        assert (pieces.count() > 0) == (rows > 0)


def test_the_whole_pipeline_on_empty_tables(spark, no_rows, labels, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    path_of(corpus_pipeline.WORD_VOCABULARY)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    no_rows.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
