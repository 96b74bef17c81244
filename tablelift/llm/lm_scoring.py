"""Language-model scores: marginal likelihood over a subword lattice.

A text's probability is that of its words and an end, a word's the sum over all of its
segmentations into pieces of an existing vocabulary. The vocabulary's scores, as a rank
distribution, start the unigram weights of the pieces; expectation-maximization over the
counted words of the training texts goes on from there. No piece is added or removed.

Words are counted once and scored once each. Documents meet their words' counts and
scores in a join by word hash: words that make up a ten-thousandth of all tokens or more,
of which there can be ten thousand at most, are sent to all tasks and summed up there; the
other words are joined, and no one of them can hold much of the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tablelift.llm.lattice import Vocabulary, expected_pieces, word_logs
from tablelift.llm.tables import written
from tablelift.llm.words import mix, text_chunks, word_hashes, word_spans

ROUNDS = 3
# A word is sent to all tasks if one in so many tokens, or more, is that word.
COMMON = 10_000
# Distinct words a task holds before it passes their counts on.
HELD_WORDS = 1_000_000
# Added to each piece's expected count.
PRIOR = 0.01
LN10 = float(np.log(10))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def load_vocabulary(path: str) -> tuple[Vocabulary, np.ndarray]:
    """(pieces, log weights to start from) of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    spelled = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
    text = [
        "" if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else model.id_to_piece(i)
        for i in ids
    ]
    vocabulary = Vocabulary(text, [spelled[f"<0x{b:02X}>"] for b in range(256)], model.eos_id())
    # Scores of such a model are ranks: the weight of a piece falls with its rank.
    ranks = np.argsort(np.argsort([-model.get_score(i) for i in ids], kind="stable"), kind="stable")
    return vocabulary, normal(1 / (ranks + 10.0))


def normal(weights: np.ndarray) -> np.ndarray:
    return np.log(weights) - np.log(weights.sum())


def _distinct(hashes, counts, trained, texts):
    """The same counts summed by hash; ``texts`` are an Arrow array of the words."""
    found, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    sums = [np.bincount(which, c, len(found)).astype(np.int64) for c in (counts, trained)]
    return found, *sums, texts.take(pa.array(first))


def word_counts(texts: DataFrame) -> DataFrame:
    """hash, word, total, trained: how often a word occurs in all, and in training texts.

    ``texts`` has columns text and trains. Counts are summed up in tasks first.
    """
    names = ["hash", "word", "total", "trained"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def passed_on() -> Iterator[pa.RecordBatch]:
            hashes, counts, trained = (np.concatenate([h[i] for h in held]) for i in range(3))
            found = _distinct(hashes, counts, trained, pa.concat_arrays([h[3] for h in held]))
            columns = [pa.array(found[0].astype(np.int64)), found[3], pa.array(found[1]), pa.array(found[2])]
            whole = pa.RecordBatch.from_arrays(columns, names=names)
            for a in range(0, whole.num_rows, 50_000):
                yield whole.slice(a, 50_000)

        for batch in batches:
            trains = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, data, offsets in text_chunks(batch.column(0)):
                data = _FOLD[data]
                starts, ends, before = word_spans(data, offsets)
                weight = np.repeat(trains[first : first + len(offsets) - 1], np.diff(before))
                hashes, place, which = np.unique(
                    word_hashes(data, starts, ends), return_index=True, return_inverse=True
                )
                sizes = ends[place] - starts[place]
                own = np.concatenate(([0], np.cumsum(sizes)))
                at = np.arange(own[-1]) - np.repeat(own[:-1] - starts[place], sizes)
                words = pa.StringArray.from_buffers(
                    len(place), pa.py_buffer(own.astype(np.int32).tobytes()), pa.py_buffer(data[at].tobytes())
                )
                counts = np.bincount(which, minlength=len(hashes))
                held.append((hashes, counts, np.bincount(which, weight, len(hashes)), words))
            if sum(len(h[0]) for h in held) > HELD_WORDS:
                yield from passed_on()
                held = []
        if held:
            yield from passed_on()

    counted = texts.mapInArrow(run, "hash long, word string, total long, trained long")
    return counted.groupBy("hash", "word").agg(F.sum("total").alias("total"), F.sum("trained").alias("trained"))


def fit_pieces(words: DataFrame, vocabulary: Vocabulary, logs: np.ndarray, ends: int, rounds: int) -> np.ndarray:
    """Log weights of the pieces after ``rounds`` of expectation-maximization over ``words``."""
    trained = words.where("trained > 0").select("word", "trained")
    for _ in range(rounds):
        now = logs

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(vocabulary.size)
            for batch in batches:
                total += expected_pieces(vocabulary, now, batch.column(0).to_pylist(), batch.column(1).to_numpy())
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["piece", "n"])

        found = trained.mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        counts = np.full(vocabulary.size, PRIOR)
        counts[found["piece"].to_numpy()] += found["n"].to_numpy()
        counts[vocabulary.end] += ends
        logs = normal(counts)
    return logs


def scored_words(words: DataFrame, vocabulary: Vocabulary, logs: np.ndarray) -> DataFrame:
    """hash, total, trained, log: each word with its log10 probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = word_logs(vocabulary, logs, batch.column(1).to_pylist()) / LN10
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(found)],
                names=["hash", "total", "trained", "log"],
            )

    return words.mapInArrow(run, "hash long, total long, trained long, log double")


def document_words(texts: DataFrame, common: pa.Table) -> DataFrame:
    """Rows of two kinds: one for each text, one for each of its words that is not common.

    ``row`` tells texts apart. A text's row has its id, what its common words add up to, and
    a hash of the row, so that these rows are spread like words; a word's row has its hash
    and how often the text has it.
    """
    keys = np.sort(common["hash"].to_numpy().astype(np.int64))
    order = np.argsort(common["hash"].to_numpy(), kind="stable")
    values = np.stack([
        np.log10(common["trained"].to_numpy() + 0.5), (common["trained"].to_numpy() > 0).astype(float),
        common["log"].to_numpy(),
    ], axis=1)[order]
    doc_type = pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("words", pa.int64()),
                          ("base", pa.float64()), ("known", pa.int64()), ("log", pa.float64())])
    names = ["row", "hash", "n", "doc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(2)):
                data = _FOLD[data]
                rows = len(offsets) - 1
                starts, ends, before = word_spans(data, offsets)
                hashes = word_hashes(data, starts, ends).astype(np.int64)
                text_of = np.repeat(np.arange(rows), np.diff(before))
                sums = np.zeros((rows, 3))
                rare = np.ones(len(hashes), bool)
                if len(keys):
                    place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                    rare = keys[place] != hashes
                    for k in range(3):
                        sums[:, k] = np.bincount(text_of[~rare], values[place[~rare], k], rows)
                # Order by text, then hash; a run of equal ones is one row.
                hashes, text_of = hashes[rare], text_of[rare]
                order = np.lexsort((hashes, text_of))
                hashes, text_of = hashes[order], text_of[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (text_of[1:] != text_of[:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(hashes)))
                own = np.arange(next_row, next_row + rows)
                next_row += rows
                part = batch.slice(first, rows)
                doc = pa.StructArray.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(before)), pa.array(sums[:, 0]),
                     pa.array(sums[:, 1].astype(np.int64)), pa.array(sums[:, 2])],
                    fields=list(doc_type),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(mix(own.astype(np.uint64)).astype(np.int64)),
                     pa.array(np.zeros(rows, np.int64)), doc], names=names,
                )
                for a in range(0, len(at), 50_000):
                    some = at[a : a + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[text_of[some]]), pa.array(hashes[some]), pa.array(n[a : a + 50_000]),
                         pa.nulls(len(some), doc_type)], names=names,
                    )

    doc = "struct<doc_id: long, held_out: boolean, words: long, base: double, known: long, log: double>"
    return texts.mapInArrow(run, f"row long, hash long, n long, doc {doc}")


def lm_scores(docs: DataFrame, held_out: Column, vocabulary_path: str, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Rows for which ``held_out`` is not true train both models. Tokens are words, A to Z in
    lower case, and one end. base_score sums log10((c + 0.5) / (N + 0.5 (V + 1))) over
    tokens, with c, N and V as counted in training texts; n_known counts tokens with c > 0.
    score is the log10 probability of the text under the lattice model.

    A null text counts as an empty one, an end alone. Rows with equal or null ids are scored
    and counted each by itself, a null ``held_out`` as false. An empty table gives an empty
    result; other columns are ignored. Words are told apart by 64-bit hashes.
    """
    marked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    words = written(word_counts(marked.select("text", (~F.col("held_out")).alias("trains"))), "words")
    facts = words.agg(
        F.sum("total").alias("total"), F.sum("trained").alias("trained"), F.count_if(F.col("trained") > 0).alias("distinct")
    ).first()
    ends = marked.where(~F.col("held_out")).count()
    tokens, distinct = (facts.trained or 0) + ends, facts.distinct + (ends > 0)
    vocabulary, logs = load_vocabulary(vocabulary_path)
    logs = fit_pieces(words, vocabulary, logs, ends, rounds)
    table = written(scored_words(words, vocabulary, logs), "scored-words")
    common = table.where(F.col("total") * COMMON >= (facts.total or 0)).drop("total").toArrow()
    rows = document_words(marked, common)
    joined = rows.join(table.select("hash", "trained", "log"), "hash", "left")
    is_doc = F.col("doc").isNotNull()
    count = F.coalesce(F.when(~is_doc, F.col("trained")), F.lit(0))
    out = joined.groupBy("row").agg(
        F.max("doc.doc_id").alias("doc_id"), F.max("doc.held_out").alias("held_out"),
        F.max("doc.words").alias("words"),
        F.sum(F.when(is_doc, F.col("doc.base")).otherwise(F.col("n") * F.log10(count + 0.5))).alias("base"),
        F.sum(F.when(is_doc, F.col("doc.known")).otherwise(F.when(count > 0, F.col("n")).otherwise(0))).alias("known"),
        F.sum(F.when(is_doc, F.col("doc.log")).otherwise(F.col("n") * F.col("log"))).alias("log"),
    )
    n_tokens = F.col("words") + 1
    below = float(np.log10(tokens + 0.5 * (distinct + 1)))
    return out.select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"),
        (F.col("known") + int(ends > 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + float(np.log10(ends + 0.5)) - n_tokens * below).alias("base_score"),
        (F.col("log") + float(logs[vocabulary.end] / LN10)).alias("score"),
    )
