import random

from tablelift.llm.line_dedup import line_dedup

from .conftest import frame
from .test_line_dedup import brute_force


def numbered(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_the_end_of_a_run_goes_too(spark):
    run = [numbered("long", 60), *(numbered(f"s{k}x", 10) for k in range(4))]
    texts = ["\n".join([numbered(f"a{i}x", 9), *run, "", numbered(f"z{i}x", 9)]) for i in range(3)]
    rows = {r.doc_id: r for r in line_dedup(frame(spark, texts)).collect()}
    assert rows[0].text == texts[0]
    for i in (1, 2):
        assert rows[i].text.split("\n") == [numbered(f"a{i}x", 9), "", numbered(f"z{i}x", 9)]
        assert rows[i].n_lines_removed == 5


def test_whole_runs_match_brute_force(spark):
    rng = random.Random(6)
    pool = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([1, 2, 5, 9, 25]))) for _ in range(9)] + ["", "  "]
    passage = [" ".join(f"p{rng.randrange(99)}" for _ in range(n)) for n in (3, 24, 7, 2, 8)]
    texts = [None, ""]
    for _ in range(60):
        lines = [rng.choice(pool) for _ in range(rng.randrange(1, 20))]
        at = rng.randrange(len(lines))
        texts.append("\n".join(lines[:at] + (passage if rng.random() < 0.5 else []) + lines[at:]))
    texts += [texts[5]] * 3
    found = {r.doc_id: r.text for r in line_dedup(frame(spark, texts), least_words=20).collect()}
    assert found == brute_force(texts, 20)


def test_the_pipeline_takes_whole_runs(spark):
    import corpus_pipeline

    run = [numbered("long", 60), *(numbered(f"s{k}x", 10) for k in range(4))]
    texts = ["\n".join([numbered(f"a{i}x", 9), *run]) for i in range(2)]
    rows = {r.doc_id: r.text for r in corpus_pipeline.without_repeated_lines(spark, frame(spark, texts), "").collect()}
    assert rows == {0: texts[0], 1: numbered("a1x", 9)}
