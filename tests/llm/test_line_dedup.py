import random
import re

from tablelift.llm.line_dedup import line_dedup

from .conftest import frame


def words_of(line):
    return len(re.findall(r"[^\x20\x09-\x0D]+", line))


def brute_force(texts, least):
    """Deletes every run of lines, of any length, whose content stood earlier."""
    seen, gone = {}, {i: set() for i in range(len(texts))}
    for i, text in enumerate(texts):
        lines = [(p, line) for p, line in enumerate((text or "").split("\n")) if words_of(line)]
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += words_of(lines[b][1])
                if total < least:
                    continue
                first = seen.setdefault(tuple(line for _, line in lines[a : b + 1]), (i, lines[b][0]))
                if first[0] != i or lines[a][0] > first[1]:
                    gone[i] |= set(range(lines[a][0], lines[b][0] + 1))
    return {
        i: None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i])
        for i, t in enumerate(texts)
    }


def test_repeated_runs_match_brute_force(spark):
    rng = random.Random(3)
    pool = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, 9))) for _ in range(12)] + ["", "  "]
    passage = [" ".join(f"p{rng.randrange(99)}" for _ in range(7)) for _ in range(4)]
    texts = [None, ""]
    for _ in range(60):
        lines = [rng.choice(pool) for _ in range(rng.randrange(1, 20))]
        at = rng.randrange(len(lines))
        texts.append("\n".join(lines[:at] + (passage if rng.random() < 0.5 else []) + lines[at:]))
    texts += [texts[5]] * 3
    found = {r.doc_id: r.text for r in line_dedup(frame(spark, texts), least_words=20).collect()}
    assert found == brute_force(texts, 20)


def test_a_run_repeated_without_gap_keeps_its_first_copy(spark):
    line = " ".join(f"w{i}" for i in range(10))
    found = line_dedup(frame(spark, ["\n".join([line] * 7)]), least_words=20).first()
    assert found.text == "\n".join([line] * 2) and found.n_lines_removed == 5
    assert found.n_chars == len(found.text)


def test_odd_rows(odd):
    out = line_dedup(odd)
    assert out.columns == [*odd.columns, "n_lines_removed"]
    rows = out.collect()
    assert len(rows) == odd.count()
    by_id = [(r.doc_id, r.text) for r in rows]
    assert (3, None) in by_id and (4, "") in by_id and (2, "") in by_id and (1, "") in by_id
    # A null doc_id comes first, so its copy of the text stays.
    assert sum(text is not None and len(text) > 200 and i is None for i, text in by_id) == 1


def test_no_rows(no_rows):
    assert line_dedup(no_rows).collect() == []
