"""Harmonic packing of tokenized documents into sequences of one capacity.

A piece longer than ``capacity / (k + 1)`` and at most ``capacity / k`` is of class
``k``, and ``k`` pieces of a class fill a sequence, whatever came before. A task
therefore packs its rows as they come, with one open sequence a class and without a
shuffle. Documents may be cut: a piece that would leave more than ``slack`` of its
sequences empty gives up ``capacity / (k + 1)`` tokens, an exact fit of the next class,
and the rest is classed again. What is left in open sequences at a task's end is laid
end to end and cut at powers of two, which need no padding.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tablelift.llm.ball_trees import spans
from tablelift.llm.words import EXACT_BYTES, text_chunks, word_hashes, word_spans

CAPACITY = 2048
# Pieces of capacity / CLASSES tokens or fewer form the last class, filled by next fit.
CLASSES = 32
# The share of a sequence that may stay empty before a piece is cut instead.
SLACK = 0.01
# Words a worker remembers the ids of; then it starts anew.
KNOWN_WORDS = 400_000
# Sequence numbers of one task.
TASK_SPAN = 1 << 33

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


# Bytes that never share a token with their neighbour of another class: letters, digits, and
# punctuation but what contractions and special tokens are spelled with.
CLASSES_OF_BYTES = np.zeros(256, np.uint8)
for _class, _members in enumerate((
    b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~",
), start=1):
    CLASSES_OF_BYTES[list(_members)] = _class
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def word_parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, parts before each row and in all): words, cut where ASCII classes change."""
    starts, ends, _ = word_spans(data, offsets)
    kind = CLASSES_OF_BYTES[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    cut[offsets] = False
    inner = np.flatnonzero(cut)
    starts, ends = np.sort(np.concatenate((starts, inner))), np.sort(np.concatenate((ends, inner)))
    return starts, ends, np.searchsorted(starts, offsets)


class WordTokenizer:
    """Ids of texts under a lower-casing vocabulary whose tokens never span white space.

    Words are cut where letters, digits and punctuation of ASCII meet, which that
    vocabulary does too, and most parts come again. A part's ids are found by its hash in a
    table of one entry a slot, for all parts of a run of texts at once; its bytes are then
    compared, so no hash stands for a word. What is not there is looked up in a dictionary,
    or encoded. Parts of letters alone are encoded many at once and told apart by the
    tokens that end a word; a run in which the numbers of parts and word ends differ, and
    any other part, is encoded by itself.
    """

    SLOT_BITS = 20

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._refuse_others()
        self._forget()

    def _refuse_others(self) -> None:
        """An error if the vocabulary minds case, or does not cut where words are cut here."""
        members = [bytes(np.flatnonzero(CLASSES_OF_BYTES == k).astype(np.uint8)).decode() for k in (1, 2, 3)]
        pairs = [x + y for a in members for b in members if a != b for x in a for y in b]
        single = {c: i.tolist() for c, i in zip("".join(members), self._encode(list("".join(members))))}
        right = all(ids.tolist() == single[pair[0]] + single[pair[1]] for pair, ids in zip(pairs, self._encode(pairs)))
        if not right or any(single[c] != single[c.lower()] for c in members[0]):
            raise ValueError("words cannot be cut by classes of characters under this vocabulary")

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.words, self.word_bounds = bytearray(), array("q", [0])
        self.pool, self.pool_bounds = bytearray(), array("q", [0])
        self.slots = np.full(1 << self.SLOT_BITS, -1, np.int64)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _keep(self, word: bytes, ids: bytes) -> None:
        self.known[word] = len(self.known)
        self.words += word
        self.word_bounds.append(len(self.words))
        self.pool += ids
        self.pool_bounds.append(len(self.pool) // 4)

    def _learn(self, words: list[bytes]) -> None:
        plain, odd = [], []
        for word in words:
            text = word.decode()
            (plain if text.isalpha() else odd).append((word, text))
        runs = [plain[i : i + 64] for i in range(0, len(plain), 64)]
        for run, ids in zip(runs, self._encode([" ".join(t for _, t in run) for run in runs])):
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(run) and cuts[-1] == len(ids):
                whole, starts = ids.tobytes(), [0, *(4 * cuts[:-1]).tolist()]
                for (word, _), start, end in zip(run, starts, (4 * cuts).tolist()):
                    self._keep(word, whole[start:end])
            else:
                odd += run
        for (word, _), ids in zip(odd, self._encode([t for _, t in odd])):
            self._keep(word, ids.tobytes())

    def _places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each part among the known ones, after learning what is new."""
        sizes = ends - starts
        slot = (word_hashes(data, starts, ends, EXACT_BYTES) >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)
        found = self.slots[slot]
        bounds, words = np.array(self.word_bounds), np.frombuffer(bytes(self.words), np.uint8)
        alike = np.flatnonzero(found >= 0)
        alike = alike[bounds[found[alike] + 1] - bounds[found[alike]] == sizes[alike]]
        same = data[spans(starts[alike], sizes[alike])] == words[spans(bounds[found[alike]], sizes[alike])]
        hit = np.zeros(len(starts), bool)
        if len(alike):
            hit[alike] = np.logical_and.reduceat(same, np.cumsum(sizes[alike]) - sizes[alike])
        missed = np.flatnonzero(~hit)
        raw = data.tobytes()
        parts = [raw[a:b] for a, b in zip(starts[missed].tolist(), ends[missed].tolist())]
        self._learn(list(set(parts) - self.known.keys()))
        found[missed] = list(map(self.known.__getitem__, parts))
        self.slots[slot[missed]] = found[missed]
        return found

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, as little-endian 32-bit numbers; null is empty."""
        for _, data, offsets in text_chunks(texts):
            if len(self.known) > KNOWN_WORDS:
                self._forget()
            data = _FOLD[data]
            starts, ends, before = word_parts(data, offsets)
            places = self._places(data, starts, ends)
            bounds = np.array(self.pool_bounds)
            counts = bounds[places + 1] - bounds[places]
            ids = np.frombuffer(bytes(self.pool), "<u4")[spans(bounds[places], counts)]
            ends = np.concatenate(([0], np.cumsum(counts)))[before]
            for a, b in zip(ends[:-1], ends[1:]):
                yield ids[a:b]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each vocabulary in a worker, kept between tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def cuts(length: int, capacity: int, classes: int, slack: float) -> Iterator[tuple[int, int]]:
    """(length, class) of the pieces that ``length`` tokens are cut into."""
    while length:
        k = min(capacity // length, classes)
        if k == classes or capacity - k * length <= slack * capacity:
            yield length, max(k, 1)
            return
        piece = min(length, capacity // (k + 1))
        yield piece, k + 1
        length -= piece


class Packer:
    """Fills the sequences of one task; ``done`` takes rows that have their final place."""

    def __init__(self, first_sequence: int, capacity: int, classes: int, slack: float):
        self.capacity, self.classes, self.slack = capacity, classes, slack
        self.next_sequence = first_sequence
        self.open: dict[int, list[tuple]] = {}
        self.filled: dict[int, int] = {}
        self.done: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """One document's ids, four bytes each."""
        total, start = len(ids) // 4, 0
        while total - start >= self.capacity:
            self._close([self._piece(doc_id, ids, start, self.capacity, total)])
            start += self.capacity
        for length, k in cuts(total - start, self.capacity, self.classes, self.slack):
            self._place(k, self._piece(doc_id, ids, start, length, total))
            start += length

    @staticmethod
    def _piece(doc_id, ids: bytes, start: int, length: int, total: int) -> tuple:
        return doc_id, start, length, ids[4 * start : 4 * (start + length)], total

    def _place(self, k: int, piece: tuple) -> None:
        pieces, filled = self.open.setdefault(k, []), self.filled.get(k, 0)
        last = k == self.classes
        if last and filled + piece[2] > self.capacity:
            self._close(pieces)
            pieces, filled = self.open[k], self.filled[k] = [], 0
        pieces.append(piece)
        self.filled[k] = filled + piece[2]
        if self.filled[k] == self.capacity or (not last and len(pieces) == k):
            self._close(pieces)
            self.open[k], self.filled[k] = [], 0

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.done.append((*piece, self.next_sequence, offset))
            offset += piece[2]
        self.next_sequence += 1

    def finish(self) -> None:
        """Lays what open sequences hold end to end, without padding."""
        rest = [piece for k in sorted(self.open) for piece in self.open[k]]
        left = sum(piece[2] for piece in rest)
        self.open, self.filled = {}, {}
        while left:
            room = min(self.capacity, 1 << (left.bit_length() - 1))
            left -= room
            pieces = []
            while room:
                doc_id, start, length, ids, total = rest.pop(0)
                taken = min(room, length)
                pieces.append((doc_id, start, taken, ids[: 4 * taken], total))
                if taken < length:
                    rest.insert(0, (doc_id, start + taken, length - taken, ids[4 * taken :], total))
                room -= taken
            self._close(pieces)

    def take(self) -> list[tuple]:
        taken, self.done = self.done, []
        return taken


def packer_of_batches(
    path: str, capacity: int, end_id: int, classes: int, slack: float, rows: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    kinds = [pa.binary() if n == "ids" else pa.int64() for n in names]
    schema = pa.schema(list(zip(names, kinds)))
    end = int(end_id).to_bytes(4, "little")

    def batch_of(pieces: list[tuple]) -> pa.RecordBatch:
        columns = zip(*pieces)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        packer = Packer(TaskContext.get().partitionId() * TASK_SPAN, capacity, classes, slack)
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                part = batch.slice(first, rows)
                for doc_id, ids in zip(part.column(0).to_pylist(), words.encode(part.column(1))):
                    packer.add(doc_id, ids.tobytes() + end)
                if done := packer.take():
                    yield batch_of(done)
        packer.finish()
        if done := packer.take():
            yield batch_of(done)

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    classes: int = CLASSES,
    slack: float = SLACK,
    rows: int = 500,
) -> DataFrame:
    """One row for each piece of a document, with its ids and its place.

    ``vocabulary`` is the file of a word-wise tokenizer, ``end_id`` closes each document,
    ``rows`` texts are tokenized together. ``capacity`` must be a power of two. Sequences
    hold ``capacity`` ids or fewer and are padded up to it, but for those whose number of
    ids is a power of two; padding is not part of the rows. Ids are little-endian 32-bit
    numbers.

    A null or empty text is its end id alone; rows with equal or null ids are documents of
    their own; an empty table gives no rows; other columns are ignored. A text of any
    length is cut, and a task holds one text and its open sequences at a time.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(packer_of_batches(vocabulary, capacity, end_id, classes, slack, rows), SCHEMA)
