import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tablelift.llm.byte_bpe import ByteBPE, PerfectHash, byte_bpe, decode_ids, encode_texts, merged, read_ranks
from tablelift.llm.queries import op13_byte_bpe
from tablelift.llm.words import text_chunks

from .conftest import SMALL, frame, path_of


@pytest.fixture(scope="module")
def path():
    return path_of("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library(path):
    """The library whose ids are to be met."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={}
    )


@pytest.fixture(scope="module")
def bpe(path):
    return ByteBPE(path)


def ids_of(bpe, texts):
    found = []
    for _, data, offsets in text_chunks(pa.array(texts, pa.string())):
        ids, before = bpe.encode(data, offsets)
        assert bpe.decode(ids).tobytes() == data.tobytes()
        found += [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])]
    return found


def test_ids_are_the_librarys(bpe, library):
    rng = random.Random(1)
    letters = list("abst'lvermd '  \n\t\x0b\x1c  éß中１٣½²!?#$-_.123 ASTRELL'") + ["'s", "'re", " '", "😀", "́", "\u0085"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["", None, "a" * 5000, " " * 3000, "ab" * 3000, "<|endoftext|>", "\x00", "x'", "'", "'s", " 's", "\n's"]
    assert ids_of(bpe, texts) == [library.encode_ordinary(t or "") for t in texts]


def test_every_character_is_of_its_kind(bpe, library):
    texts = [f"a{chr(c)}1{chr(c)}{chr(c)} {chr(c)}" for c in range(0, 0x110000, 7) if not 0xD800 <= c <= 0xDFFF]
    assert ids_of(bpe, texts) == library.encode_ordinary_batch(texts)


def test_merging_takes_the_lowest_rank_first_and_the_leftmost_of_equals():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"ab": 257, b"aab": 258, b"bc": 259}

    def plain(word):
        parts = [word[i : i + 1] for i in range(len(word))]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(2)
    for _ in range(2000):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 14)))
        assert merged(word, ranks, 3) == plain(word)


def test_the_hash_is_perfect_and_minimal():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 5000, dtype=np.uint64))
    table = PerfectHash(keys)
    assert sorted(table.places(keys).tolist()) == list(range(len(keys)))
    assert PerfectHash(keys[:0]).places(keys[:3]).tolist() == [-1, -1, -1]


def test_a_small_vocabulary_of_its_own(tmp_path):
    ranks = [bytes([b]) for b in range(256)] + [b"th", b"the", b" the"]
    path = tmp_path / "own.ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(ranks)))
    assert ids_of(ByteBPE(str(path)), ["the the", "th", "hte"]) == [[257, 258], [256], [104, 116, 101]]


def test_odd_rows(odd, path, library):
    rows = byte_bpe(odd, path).collect()
    wanted = [(r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in rows), key=repr) == sorted(
        ((i, library.encode_ordinary(t), t.encode()) for i, t in wanted), key=repr
    )


def test_no_rows(no_rows, path):
    assert byte_bpe(no_rows, path).collect() == []


def test_decoding_alone(spark, path, library):
    frame_of_ids = spark.createDataFrame([(1, [1, 2, 3]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: bytes(r.decoded) for r in decode_ids(frame_of_ids, path).collect()} == {
        1: library.decode_bytes([1, 2, 3]), 2: b"", 3: b""
    }
    with pytest.raises(Exception, match="not in the vocabulary"):
        decode_ids(spark.createDataFrame([(1, [99_999_999])], "doc_id long, ids array<int>"), path).collect()


def test_a_long_unbroken_text(spark, path, library):
    text = "abcdefghij" * 20_000
    assert encode_texts(frame(spark, [text]), path).first().ids == library.encode_ordinary(text)


def test_the_query_over_whole_documents(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    wanted = set()
    for row in docs:
        ids = library.encode_ordinary(row.text or "")
        wanted.add((
            row.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((row.text or "").encode()).hexdigest(),
        ))
    found = op13_byte_bpe(spark, SMALL).collect()
    assert len(found) == len(docs) and {tuple(r) for r in found} == wanted
