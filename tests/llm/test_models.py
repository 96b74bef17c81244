import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelift.llm import chains, lattice, quality_model
from tablelift.llm.language import language
from tablelift.llm.lm_scoring import lm_scores
from tablelift.llm.queries import id_part
from tablelift.llm.toxicity import toxicity, toxicity_of

from .conftest import SMALL, frame, path_of

PIECES = "piece_bpe_32k.model"


def test_forward_backward_matches_all_paths():
    rng = np.random.default_rng(1)
    before, n = np.array([0, 5, 5, 6, 13, 30]), 3
    scores, start, move = rng.normal(size=(30, n)), rng.normal(size=n), rng.normal(size=(n, n))
    found, first, pairs = chains.expectations(scores, before, start, move)
    for a, b in zip(before[:-1], before[1:]):
        if 0 < b - a < 8:
            wanted = np.zeros((b - a, n))
            for path in itertools.product(range(n), repeat=b - a):
                steps = sum(move[p, q] for p, q in zip(path, path[1:]))
                weight = math.exp(start[path[0]] + steps + sum(scores[a + i, p] for i, p in enumerate(path)))
                wanted[np.arange(b - a), list(path)] += weight
            assert np.allclose(found[a:b], wanted / wanted.sum(axis=1, keepdims=True))
    short = chains.forward_backward(scores, before, start, move, length=4)
    assert np.allclose(found, chains._scaled(short[0] * short[1]))
    assert abs(first.sum() - 4) < 1e-9 and abs(pairs.sum() - 26) < 1e-9


def test_lattice_matches_all_segmentations():
    pieces = ["", "▁", "a", "b", "ab", "▁a", "ba", "bab", "▁ab"] + [""] * 256
    voc = lattice.Vocabulary(pieces, list(range(9, 265)), 0)
    logs = np.log(np.random.default_rng(2).dirichlet(np.ones(len(pieces))))

    def ways(word):
        if not word:
            yield []
        for k in range(1, len(word) + 1):
            if word[:k] in pieces[1:9]:
                yield from ([pieces.index(word[:k]), *rest] for rest in ways(word[k:]))
        if word and word[0] not in pieces:
            yield from ([9 + byte for byte in word[0].encode()] + rest for rest in ways(word[1:]))

    words = ["", "a", "abab", "babé", "é", "bbbb", "a▁b", "x"]
    found = lattice.word_logs(voc, logs, words)
    expected = lattice.expected_pieces(voc, logs, words, np.arange(1, 9))
    wanted = np.zeros(len(pieces))
    for times, (word, log) in enumerate(zip(words, found), 1):
        all_ways = list(ways("▁" + word))
        chances = np.array([math.exp(sum(logs[i] for i in way)) for way in all_ways])
        assert abs(math.log(chances.sum()) - log) < 1e-9
        for way, chance in zip(all_ways, chances / chances.sum()):
            np.add.at(wanted, way, times * chance)
    assert np.allclose(expected, wanted)


def test_scores_count_like_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r.doc_id: r for r in lm_scores(docs, id_part(5) == 1, path_of(PIECES), rounds=1).collect()}
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    texts = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", r.text.translate(lower)) + [""] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    c = Counter(w for i, ws in texts.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in texts.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(ws), n)
        assert r.n_known == sum(c[w] > 0 for w in ws)
        assert abs(r.base_score - sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) < 1e-6 * len(ws)
        assert r.score < 0


def test_scores_of_odd_rows(odd, no_rows):
    rows = lm_scores(odd, id_part(5) == 1, path_of(PIECES), rounds=1).collect()
    assert len(rows) == odd.count() and all(r.score is not None for r in rows)
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (3, 4, 5))
    assert lm_scores(no_rows, id_part(5) == 1, path_of(PIECES)).collect() == []


def test_character_model_sums_to_one(spark):
    texts = ["the cat sat on the mat", "the dog sat", "Ünder 12 #!", ""]
    model = quality_model.fit(quality_model.gram_counts(frame(spark, texts)))
    p = 2.0 ** model.logs().astype(float).reshape(-1, quality_model.CLASSES)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    codes, bounds = quality_model.grams(["ab", "", "c"])
    a, b, c = (int(quality_model.classes_of(x)[0]) for x in "abc")
    assert codes.tolist() == [a, a << 6 | b, a << 12 | b << 6, 0, c, c << 6] and bounds.tolist() == [0, 3, 4, 6]


def test_unlike_texts_are_dropped(spark):
    rng = random.Random(6)
    clean = [" ".join(rng.choice(["the", "cat", "sat", "on", "mat"]) for _ in range(40)) for _ in range(400)]
    docs = frame(spark, clean + ["x#q%z&k$ " * 20] * 20)
    found = quality_model.quality_model(docs, docs.where("doc_id < 300").select("doc_id")).collect()
    assert not any(r.kept for r in found if r.doc_id >= 400)
    assert sum(r.kept for r in found if r.doc_id < 400) >= 390


def test_quality_model_of_odd_rows(odd, no_rows):
    for ids in (odd.select("doc_id"), odd.select("doc_id").where("false")):
        rows = quality_model.quality_model(odd, ids).collect()
        assert len(rows) == odd.count() and all(r.kept is not None for r in rows)
    assert quality_model.quality_model(no_rows, no_rows.select("doc_id")).collect() == []


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = language(docs, id_part(4) != 2).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(id_part(4) == 2).collect()
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in held)


def test_code_switched_text_is_shared_out(spark):
    de, en = "der hund und die katze gehen nach hause", "the dog and the cat walk home again"
    docs = frame(spark, [de] * 30 + [en] * 30 + [f"{de} {de} {en}"], lang=["de"] * 30 + ["en"] * 30 + [None])
    row = language(docs, F.col("doc_id") < 60).where("doc_id = 60").first()
    assert row.lang_pred == "de" and 0.5 < row.score < 0.85 and abs(sum(row.shares.values()) - 1) < 1e-6


def test_language_of_odd_rows(odd, no_rows):
    found = language(odd, F.lit(True)).collect()
    assert len(found) == odd.count()
    assert all((r.lang_pred == "und") == (r.doc_id in (3, 4, 5, 9) or (r.doc_id is None and r.n_words == 0)) for r in found)
    assert {r.lang_pred for r in language(odd, F.lit(False)).collect()} == {"und"}
    assert language(no_rows, F.lit(True)).collect() == []


def test_toxic_words_are_found_out_of_sample(spark):
    rng = random.Random(8)
    texts, toxic = [], []
    for i in range(900):
        words = [f"w{rng.randrange(400)}" for _ in range(40)]
        toxic.append(int(i % 6 == 0))
        if toxic[-1]:
            words[rng.randrange(40)] = rng.choice(["Foul", "vile!", "nasty"])
        texts.append(" ".join(words))
    docs = frame(spark, texts)
    marks = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic[:600])], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity(docs, marks).collect()}
    assert np.mean([found[i].toxic == bool(toxic[i]) for i in range(600, 900)]) > 0.99
    assert all(r.kept != r.toxic for r in found.values())


def test_toxicity_of_odd_rows(odd, no_rows, labels):
    out = toxicity_of(odd, labels)
    assert sorted(out.columns) == sorted({*odd.columns, "p_low_quality", "p_toxic", "toxic"})
    assert out.count() == odd.count() and toxicity(odd, labels).count() == odd.count()
    assert toxicity(no_rows, labels).collect() == []
    assert not any(r.toxic for r in toxicity(odd, labels.where("false")).collect())


@pytest.mark.parametrize("name", [n for n in ("pipeline",)])
def test_pipeline_stages(spark, name):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = docs.count()
    for stage, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, SMALL).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], stage
        assert docs.count() == docs.select("doc_id").distinct().count() <= ids
        ids = docs.count()
    packed = corpus_pipeline.run(spark, SMALL)
    assert packed.select("doc_id").distinct().count() == ids
