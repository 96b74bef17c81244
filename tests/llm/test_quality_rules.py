import math
import random
import re

from tablelift.llm.quality_rules import at_most, measures, quality_rules

from .conftest import frame


def counts(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_counts_match_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n ", "a", "a b c", "a b c a b c", "x " * 9, "é|# é|#\né|#\n\n"]
    for _ in range(60):
        n = rng.randrange(40)
        texts.append("".join(rng.choice(["a", "bé", "c#", "D"]) + rng.choice([" ", "  ", "\n", "\t", "\x0b"]) for _ in range(n)))
    found = measures(frame(spark, texts)).collect()
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(texts[r.doc_id])


def test_binomial_tail(spark):
    for hits, trials in ((0, 50), (3, 400), (9, 2000)):
        exact = sum(math.comb(trials, j) * 0.01**j * 0.99 ** (trials - j) for j in range(hits + 1))
        df = spark.range(1).selectExpr(f"cast({hits} as long) AS hits", f"cast({trials} as long) AS trials")
        assert abs(df.select(at_most(df.hits, df.trials, 0.01)).first()[0] - exact) < 1e-9


def test_cutoffs_follow_the_evidence(spark):
    """Symbols mark bad text where enough good text is known; elsewhere no rule may act."""
    clean, dirty = "plain words " * 40, "## $$ words " * 40
    clean = " ".join(f"w{i}" for i in range(80))
    dirty = " ".join(f"w{i}##" for i in range(80))
    n = 1500
    texts = [clean] * n + [dirty] * 200 + [clean] * 50 + [dirty] * 50
    docs = frame(spark, texts, lang=["en"] * (n + 200) + ["de"] * 100)
    marks = [(i, int(t == clean), 0) for i, t in enumerate(texts) if i % 2 == 0 or i < n]
    found = quality_rules(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    assert all(r.kept == (r.n_symbols == 0 or r.doc_id >= n + 200) for r in found)
    assert not any(r.base_failed for r in found)


def test_odd_rows(odd, labels):
    found = quality_rules(odd, labels).collect()
    assert len(found) == odd.count()
    assert all(r.base_failed and not r.kept for r in found if r.n_words < 50)


def test_no_rows(no_rows, odd, labels):
    assert quality_rules(no_rows, labels).collect() == []
    assert quality_rules(odd, labels.where("false")).count() == odd.count()
