import random

import pytest

from tablelift.llm.mixing import mix
from tablelift.llm.near_duplicates import bands_for
from tablelift.llm.packing import TASK_SPAN

from .conftest import SCHEMA, frame, path_of
from .test_near_duplicates import shingles

pipeline = pytest.importorskip("corpus_pipeline")


def resemblance(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def test_near_copies_from_080_go(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(204)]
        # Four edits apart from each other part 20 of 200 shingles: 180 of 220 are shared.
        texts += [" ".join(base), " ".join(f"n{i}" if i in (20, 60, 100, 140) else w for i, w in enumerate(base))]
        # Five part 25: 175 of 225 are not enough.
        far = [f"w{rng.randrange(10**6)}" for _ in range(204)]
        texts += [" ".join(far), " ".join(f"n{i}" if i in (20, 60, 100, 140, 180) else w for i, w in enumerate(far))]
    assert all(0.80 <= resemblance(*texts[i : i + 2]) < 0.85 for i in range(0, len(texts), 4))
    assert all(resemblance(*texts[i : i + 2]) < 0.80 for i in range(2, len(texts), 4))
    kept = pipeline.without_near_copies(spark, frame(spark, texts), "").collect()
    assert sorted(r.doc_id for r in kept) == [i for i in range(len(texts)) if i % 4 != 1]


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_bands_fit_the_threshold(percent):
    missed = lambda bands: (1 - (percent / 100) ** 6) ** bands
    assert missed(bands_for(percent)) <= 1 / 80_000 < missed(bands_for(percent) - 1)


def test_one_row_of_each_group_stays(spark):
    a, b, c, d = (" ".join(f"{name}{i}" for i in range(100)) for name in "abcd")
    near_c = c.replace("c50", "other")
    rows = [
        (2, a), (1, a), (2, b),  # the copy goes, the other text under its id stays
        (3, c), (3, c), (4, near_c), (None, c),
        (None, d), (None, d), (None, d.replace("d50", "other")),
        (None, None), (None, None), (5, ""), (6, ""),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    kept = pipeline.without_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    # Which of the null rows of one group stays is open.
    last = [row for row in found if row[0] is None and row[1]]
    assert len(last) == 1 and last[0] in rows[7:10]
    wanted = [(1, a), (2, b), (3, c), (None, None), (None, None), (5, ""), (6, "")]
    assert sorted(map(repr, set_aside(found, last))) == sorted(map(repr, wanted))


def set_aside(rows, some):
    return [row for row in rows if row not in some]


def test_sequences_follow_the_mix_over_several_files(spark, tmp_path):
    path_of(pipeline.WORD_VOCABULARY)
    rng = random.Random(9)
    texts = [f"word{i} " * rng.randrange(200, 1500) for i in range(240)]
    docs = frame(spark, texts, source=[rng.choice("aaab") for _ in texts])
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pipeline.mixed(spark, docs, "").write.parquet(str(tmp_path / "mixed"))
        read = spark.read.parquet(str(tmp_path / "mixed"))
        assert len(read.inputFiles()) > 1
        pieces = pipeline.packed(spark, read, "").select("doc_id", "sequence_id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    place = {r.doc_id: (r.slot, r.position) for r in mix(docs).collect()}
    tasks = {}
    for r in pieces:
        tasks.setdefault(r.sequence_id // TASK_SPAN, set()).add(place[r.doc_id])
    assert set().union(*tasks.values()) == set(place.values()) and len(tasks) > 1
    spans = [tasks[k] for k in sorted(tasks)]
    assert all(max(a) < min(b) for a, b in zip(spans, spans[1:]))
