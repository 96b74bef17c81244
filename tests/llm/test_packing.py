import random
from collections import Counter

import numpy as np
import pytest

from tablelift.llm.packing import Packer, cuts, pack

from .conftest import frame, path_of

WORDS = "word_bpe_49k.json"


def test_cuts_fill_their_class():
    for length in range(1, 256):
        pieces = list(cuts(length, 256, 16, 0.02))
        assert sum(n for n, _ in pieces) == length
        for n, k in pieces:
            assert n * k <= 256 and (k == 16 or 256 - n * k <= 0.02 * 256 or n == 256 // k)


def test_sequences_are_full_but_for_powers_of_two():
    rng = random.Random(1)
    packer = Packer(0, 256, 16, 0.02)
    lengths = [rng.choice([1, 3, 40, 100, 130, 255, 256, 257, 1000]) for _ in range(2000)]
    for i, n in enumerate(lengths):
        packer.add(i, np.arange(n, dtype="<u4").tobytes())
    packer.finish()
    ids, used, spans = {}, {}, {}
    for doc, start, n, body, total, seq, offset in packer.take():
        assert total == lengths[doc] and len(body) == 4 * n and offset == used.get(seq, 0)
        used[seq] = offset + n
        spans.setdefault(doc, []).append((start, n))
        ids.setdefault(doc, {})[start] = body
    for doc, n in enumerate(lengths):
        assert b"".join(ids[doc][s] for s in sorted(ids[doc])) == np.arange(n, dtype="<u4").tobytes()
    assert sorted(used) == list(range(len(used))) and max(used.values()) <= 256
    padding = sum(256 - n for n in used.values() if n & (n - 1))
    assert padding < 0.02 * sum(lengths)


def rebuilt(rows):
    parts = {}
    for r in rows:
        parts.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    return {k: b"".join(body for _, body in sorted(v)) for k, v in parts.items()}


def test_ids_are_those_of_the_whole_text(spark):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    odd = ["", None, "İstanbul ΣΑΣ", "it's we've", "áe 12 #!?  x", "<|endoftext|>", "日本 語\x85x", "Straße. straße"]
    words = ["Alpha", "beta,", "gamma's", "δέλτα", "ïx", "x1y2", "..."]
    texts = odd + [" ".join(rng.choice(words) for _ in range(rng.randrange(900))) for _ in range(40)]
    whole = Tokenizer.from_file(path_of(WORDS))
    found = rebuilt(pack(frame(spark, texts), path_of(WORDS), rows=7).collect())
    assert len(found) == len(texts)
    for (i, _), body in found.items():
        wanted = whole.encode(texts[i] or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(body, "<u4").tolist() == wanted, texts[i]


def test_odd_rows(odd, no_rows):
    rows = pack(odd, path_of(WORDS)).collect()
    whole = Counter(r.doc_id for r in rows if r.start == 0)
    assert whole == Counter(r.doc_id for r in odd.select("doc_id").collect())
    assert pack(no_rows, path_of(WORDS)).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        pack(odd, path_of(WORDS), capacity=1000)


def test_ids_are_the_librarys():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from tablelift.llm.packing import WordTokenizer

    rng = random.Random(8)
    letters = list("abcSTrevm'd 12.,!?-<|>&=\"()é́ßÀİΣ̸中\t\n") + ["'s", "'re", "LL", "<|endoftext|>", "  ", "ﬁ", "½"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(4000)] + ["", None, "a" * 9000]
    path = path_of(WORDS)
    library = Tokenizer.from_file(path)
    own = WordTokenizer(path)
    for _ in range(2):
        found = [ids.tolist() for ids in own.encode(pa.array(texts, pa.string()))]
        assert found == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_a_vocabulary_that_minds_case_is_refused(tmp_path):
    from tokenizers import Tokenizer, models

    from tablelift.llm.packing import WordTokenizer

    chars = {chr(c): c for c in range(33, 127)}
    Tokenizer(models.BPE(chars, [])).save(str(tmp_path / "plain.json"))
    with pytest.raises(ValueError, match="cannot be cut"):
        WordTokenizer(str(tmp_path / "plain.json"))
