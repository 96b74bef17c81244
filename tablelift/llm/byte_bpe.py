"""Byte-level BPE with the ranks of an existing vocabulary: texts to ids and back.

A text is split into pre-tokens, whose bytes are looked up in two tiers. A pre-token that
is a token itself is found by a minimal perfect hash over the vocabulary, for all
pre-tokens of a run of texts at once; its bytes are then compared, so no hash stands for a
token. The others are merged: neighbours in a linked list of bytes, the pair of lowest
rank first and of equal ones the leftmost, taken off a heap.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablelift.llm.words import EXACT_BYTES, mix, text_chunks, word_hashes

# Merged pre-tokens a worker remembers; then it starts anew. Longer ones are merged each time.
KNOWN_WORDS = 500_000
KNOWN_BYTES = 64
# Ids decoded together.
DECODED_IDS = 1 << 20

OTHER, LETTER, NUMBER, SPACE = range(4)
_U = np.uint64


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file, one a line: base64 of the bytes, and the rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def character_kinds() -> np.ndarray:
    """For each code point whether it is a letter, a number or white space.

    Libraries differ in the version of Unicode they know, so the one whose ids are to be
    met is asked: with a class as its pattern it encodes the characters of that class alone.
    """
    import tiktoken

    kinds = np.full(0x110000, OTHER, np.uint8)
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    single = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        found = tiktoken.Encoding("kinds", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        kinds[_points(bytes(found.encode_ordinary(text)))] = kind
    return kinds


def _points(data: bytes) -> np.ndarray:
    """Code points of UTF-8; a byte that is none stands for itself, as a lone surrogate."""
    text = data.decode("utf-8", "surrogateescape")
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def pre_tokens(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, pre-tokens before each text and in all) of texts laid end to end.

    Pre-tokens are 's, 't, 're, 've, 'm, 'll and 'd; runs of letters, of numbers and of
    other characters, each with one space before it; and white space, of which the last
    character before such a run stands alone unless it is the run's space.
    """
    points = _points(data.tobytes())
    sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    sizes[(points >> 7) == 0xDC80 >> 7] = 1
    at = np.zeros(len(points) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    text_starts = np.searchsorted(at, offsets)
    n = len(points)
    opens = np.zeros(n + 3, bool)
    opens[text_starts] = True
    opens[n:] = True
    kind = kinds[points]
    runs = opens[: n + 1].copy()
    runs[1:n] |= kind[1:] != kind[:-1]
    starts = runs.copy()
    # The last white space before another run is a pre-token, or opens that run.
    last = np.flatnonzero((kind == SPACE) & runs[1:] & ~opens[1 : n + 1])
    starts[last] = True
    starts[last[points[last] == 0x20] + 1] = False
    # An apostrophe that opens a pre-token, and what may follow it.
    marks = np.flatnonzero((points == 0x27) & starts[:n])
    after = np.concatenate((points, np.zeros(2, points.dtype)))
    one, two = after[marks + 1], after[marks + 2]
    one_fits, two_fit = ~opens[marks + 1], ~opens[marks + 1] & ~opens[marks + 2]
    short = one_fits & np.isin(one, [ord(c) for c in "stmd"])
    long = two_fit & ((((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
    starts[marks[short | long] + 1] = False
    starts[marks[short] + 2] = True
    starts[marks[long] + 3] = True
    places = np.flatnonzero(starts[:n])
    bounds = at[np.append(places, n)]
    return bounds[:-1], bounds[1:], np.searchsorted(places, text_starts)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys, as levels of bitmaps.

    A key that is alone in its slot of a level has the number of such slots before it as
    its place; keys that share a slot go on to the next level.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        placed = 0
        while len(keys):
            size = 2 * len(keys) + 1
            slots = self._slots(keys, len(self.levels), size)
            alone = np.bincount(slots, minlength=size) == 1
            self.levels.append(np.where(alone, np.cumsum(alone) - 1 + placed, -1).astype(np.int32))
            placed += int(alone.sum())
            keys = keys[~alone[slots]]

    @staticmethod
    def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + _U(level * 0x9E3779B97F4A7C15 % (1 << 64))) % _U(size)).astype(np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place; a key that is not in the set has any place, or -1."""
        found = np.full(len(keys), -1, np.int32)
        left = np.arange(len(keys))
        for level, ranks in enumerate(self.levels):
            found[left] = ranks[self._slots(keys[left], level, len(ranks))]
            left = left[found[left] < 0]
        return found


def merged(word: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """The ids that merging the bytes of ``word`` leaves; no token has more than ``longest`` bytes."""
    n, find = len(word), ranks.get
    # The end of the piece that starts at a byte (0 where none does), and the start before it.
    ends = array("q", range(1, n + 1))
    before = array("q", range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = find(word[i : i + 2])
        if found is not None:
            heap.append(found << 40 | i)
    heapq.heapify(heap)
    while heap:
        entry = heapq.heappop(heap)
        start = entry & 0xFFFFFFFFFF
        middle = ends[start]
        if not middle or middle == n:
            continue
        stop = ends[middle]
        # Pieces that have changed since make other tokens.
        if stop - start > longest or find(word[start:stop]) != entry >> 40:
            continue
        ends[start], ends[middle] = stop, 0
        if stop < n:
            before[stop] = start
            if ends[stop] - start <= longest:
                found = find(word[start : ends[stop]])
                if found is not None:
                    heapq.heappush(heap, found << 40 | start)
        left = before[start]
        if left >= 0 and stop - left <= longest:
            found = find(word[left:stop])
            if found is not None:
                heapq.heappush(heap, found << 40 | left)
    ids, start = [], 0
    while start < n:
        ids.append(ranks[word[start : ends[start]]])
        start = ends[start]
    return ids


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every span, one span after the other."""
    bounds = np.cumsum(sizes)
    return np.arange(bounds[-1] if len(bounds) else 0) + np.repeat(starts - bounds + sizes, sizes)


class ByteBPE:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        count = max(self.ranks.values(), default=-1) + 1
        self.sizes = np.zeros(count, np.int64)
        self.sizes[list(self.ranks.values())] = [len(token) for token in self.ranks]
        self.longest = int(self.sizes.max(initial=0))
        self.bounds = np.concatenate(([0], np.cumsum(self.sizes)))
        self.bytes = np.zeros(self.bounds[-1], np.uint8)
        for token, rank in self.ranks.items():
            self.bytes[self.bounds[rank] : self.bounds[rank + 1]] = np.frombuffer(token, np.uint8)
        self.kinds = None
        self._forget()

    def _prepare(self) -> None:
        """What encoding needs and decoding does not."""
        used = np.flatnonzero(self.sizes)
        keys = word_hashes(self.bytes, self.bounds[used], self.bounds[used + 1], EXACT_BYTES)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two tokens of this vocabulary share a hash")
        self.hash = PerfectHash(keys)
        self.token_at = np.zeros(len(used), np.int64)
        self.token_at[self.hash.places(keys)] = used
        self.kinds = character_kinds()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool, self.pool_bounds = array("i"), array("q", [0])

    def _whole(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The id of each pre-token that is a token, else -1."""
        sizes = ends - starts
        places = self.hash.places(word_hashes(data, starts, ends, EXACT_BYTES))
        ids = self.token_at[places] if len(self.token_at) else np.zeros(len(places), np.int64)
        found = np.flatnonzero((places >= 0) & (self.sizes[ids] == sizes))
        own = data[_spread(starts[found], sizes[found])]
        same = own == self.bytes[_spread(self.bounds[ids[found]], sizes[found])]
        # A pre-token has one byte or more, so no span is empty.
        firsts = np.cumsum(sizes[found]) - sizes[found]
        out = np.full(len(starts), -1, np.int64)
        if len(found):
            right = found[np.logical_and.reduceat(same, firsts)]
            out[right] = ids[right]
        return out

    def _entry(self, word: bytes) -> int:
        """The place of the ids of a pre-token in the pool."""
        place = self.known.get(word)
        if place is None:
            self.pool.extend(merged(word, self.ranks, self.longest))
            self.pool_bounds.append(len(self.pool))
            place = len(self.pool_bounds) - 2
            if len(word) <= KNOWN_BYTES:
                self.known[word] = place
        return place

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids before each text and in all) of texts laid end to end."""
        if self.kinds is None:
            self._prepare()
        starts, ends, before = pre_tokens(data, offsets, self.kinds)
        whole = self._whole(data, starts, ends)
        if len(self.pool_bounds) > KNOWN_WORDS:
            self._forget()
        missed = np.flatnonzero(whole < 0)
        raw = data.tobytes()
        spans = zip(starts[missed].tolist(), ends[missed].tolist())
        entries = np.array([self._entry(raw[a:b]) for a, b in spans], np.int64)
        pool, bounds = np.array(self.pool, np.int32), np.array(self.pool_bounds, np.int64)
        counts = np.ones(len(starts), np.int64)
        counts[missed] = bounds[entries + 1] - bounds[entries]
        places = np.concatenate(([0], np.cumsum(counts)))
        ids = np.empty(places[-1], np.int32)
        hit = whole >= 0
        ids[places[:-1][hit]] = whole[hit]
        ids[_spread(places[:-1][missed], counts[missed])] = pool[_spread(bounds[entries], counts[missed])]
        return ids, places[before]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after the other."""
        return self.bytes[_spread(self.bounds[ids], self.sizes[ids])]


_CODERS: dict[str, ByteBPE] = {}


def coder(path: str) -> ByteBPE:
    """One coder for each vocabulary in a worker, kept between tasks."""
    if path not in _CODERS:
        _CODERS[path] = ByteBPE(path)
    return _CODERS[path]


def encode_texts(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and ids, an array of the token ids of the whole text, for every row of ``docs``.

    ``ranks_path`` names a rank file that every executor can read. Special tokens are
    ordinary text. A null or empty text has no ids; rows with equal or null doc_id are
    encoded each by itself; other columns are ignored; an empty table gives an empty
    result. Texts are encoded in runs of two megabytes, a longer one alone; an unbroken
    pre-token of n bytes that is no token takes memory in proportion to n.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks_path)
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                ids, before = bpe.encode(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(ids))
                doc_ids = batch.column(0).slice(first, len(lists))
                yield pa.RecordBatch.from_arrays([doc_ids, lists], names=["doc_id", "ids"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids and decoded, the bytes the ids stand for, for every row of ``encoded``.

    Null ids count as none. An id that the vocabulary does not have is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks_path)
        for batch in batches:
            bounds = np.concatenate(([0], np.cumsum(batch.column(1).value_lengths().fill_null(0).to_numpy())))
            first = 0
            while first < batch.num_rows:
                last = int(np.searchsorted(bounds, bounds[first] + DECODED_IDS, "right")) - 1
                last = max(first + 1, min(last, batch.num_rows))
                part = batch.slice(first, last - first)
                ids = part.column(1).flatten().to_numpy()
                if len(ids) and not (0 <= ids.min() and ids.max() < len(bpe.sizes) and bpe.sizes[ids].all()):
                    raise ValueError("an id is not in the vocabulary")
                ends = np.concatenate(([0], np.cumsum(bpe.sizes[ids])))[bounds[first : last + 1] - bounds[first]]
                decoded = pa.Array.from_buffers(
                    pa.binary(), last - first,
                    [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(bpe.decode(ids))],
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), decoded], names=["doc_id", "ids", "decoded"]
                )
                first = last

    wanted = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return wanted.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def byte_bpe(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids and decoded of every row of ``docs``: its text encoded, and decoded again."""
    return decode_ids(encode_texts(docs, ranks_path), ranks_path)
