"""Removal of repeated runs of lines by winnowing over line hashes.

Lines with a word are hashed. The window of a line reaches from it to the first line with
which it holds ``least_words`` words; the least hash of a window is a fingerprint, so two
equal runs of that many words always share one, wherever they stand. Only windows over a
fingerprint that occurs in more than one place are looked at again: their contents are
matched, and the first place of each content is found. A match of many lines is a chain
of overlapping windows, which starts where the texts begin to agree and ends with the last
line from which they agree for a whole window. Lines after that window are matched by the
windows that reach back from a line: with them all of a run is taken. Later places are
deleted, the first one stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from tablelift.llm.tables import written

LEAST_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


def numbered_lines(docs: DataFrame) -> DataFrame:
    """doc_id, body, pos, hash, words: the lines that hold a word, by text."""
    lines = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.xxhash64("text").alias("body"),
        F.posexplode(F.split("text", "\n")).alias("pos", "line"),
    )
    return lines.select(
        "doc_id", "body", "pos",
        # Two hashes of a line together tell lines of any corpus apart.
        F.struct(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")).alias("hash"),
        F.regexp_count("line", F.lit(WORD)).alias("words"),
    ).where("words > 0")


def _over(reach: WindowSpec) -> list[Column]:
    return [
        F.min("pos").over(reach).alias("first"), F.max("pos").over(reach).alias("last"),
        F.min(F.struct("hash", "pos")).over(reach).alias("mark"),
        F.collect_list("hash").over(reach).alias("held"),
    ]


def _doc() -> WindowSpec:
    return W.partitionBy("doc_id", "body")


def _as_windows(found: DataFrame) -> DataFrame:
    """doc_id, body, pos, last, mark, mark_pos, content of windows.

    ``mark`` is the least line hash of the window, first found at ``mark_pos``, and
    ``content`` a hash of all of it.
    """
    content = F.struct(F.xxhash64("held").alias("c1"), F.xxhash64(F.lit(1), "held").alias("c2"))
    return found.select(
        "doc_id", "body", F.col("first").alias("pos"), "last", F.col("mark.hash").alias("mark"),
        F.col("mark.pos").alias("mark_pos"), content.alias("content"),
    )


def _before() -> Column:
    """Words of a text before a line: the window of a line is a range of them."""
    return F.sum("words").over(_doc().orderBy("pos").rowsBetween(W.unboundedPreceding, 0)) - F.col("words")


def windows_ahead(lines: DataFrame, least_words: int) -> DataFrame:
    """The windows of ``least_words`` words that reach from each line on."""
    whole = F.sum("words").over(_doc())
    counted = lines.select("*", _before().alias("before"), whole.alias("whole"))
    reach = _doc().orderBy("before").rangeBetween(0, least_words - 1)
    found = counted.select("doc_id", "body", "whole", "before", *_over(reach))
    return _as_windows(found.where(F.col("whole") - F.col("before") >= least_words))


def windows_back(lines: DataFrame, least_words: int) -> DataFrame:
    """What else it takes to leave no gap in a run: the windows that reach back from each
    line, but for those that are windows of their first line too, and pairs of lines that
    are windows each, with which lines without a word in between go, here or there."""
    # Words up to the end of a line, and without it, bound the window that reaches back.
    counted = lines.withColumn("before", _before()).withColumn("upto", F.col("before") + F.col("words"))
    reach = _doc().orderBy("upto").rangeBetween(1 - least_words, 0)
    back = counted.select("doc_id", "body", "upto", "before", *_over(reach), F.min("before").over(reach).alias("since"))
    own = (F.col("upto") >= least_words) & (F.col("before") - F.col("since") >= least_words)
    pair = _doc().orderBy("upto").rowsBetween(-1, 0)
    pairs = counted.select("doc_id", "body", *_over(pair), F.min("words").over(pair).alias("least"))
    parted = (F.col("least") >= least_words) & (F.col("last") > F.col("first"))
    return _as_windows(back.where(own)).union(_as_windows(pairs.where(parted)))


def _matched(found: DataFrame) -> DataFrame:
    """The windows whose content stands in several places, each with its first place."""
    # Fingerprints with more than one place; windows that share one place see the same.
    place = F.struct("doc_id", "body", "mark_pos")
    marks = found.groupBy("mark").agg(F.min(place).alias("one"), F.max(place).alias("other"))
    marks = marks.where("NOT (one <=> other)").select("mark")
    matched = found.join(marks, "mark").drop("mark", "mark_pos")
    firsts = matched.groupBy("content").agg(
        F.min(F.struct("doc_id", "body", "pos", "last")).alias("first"), F.count("*").alias("places")
    ).where("places > 1").drop("places")
    return matched.join(firsts, "content")


def _of_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows whose doc_id and body are among those of ``texts``."""
    texts = texts.select(F.col("doc_id").alias("__doc_id"), F.col("body").alias("__body"))
    same = rows["doc_id"].eqNullSafe(F.col("__doc_id")) & (rows["body"] == F.col("__body"))
    return rows.join(texts, same, "left_semi")


def repeated_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, body, gone: positions of the lines of later repeated runs, by text.

    Every run has the window ahead of its first line, so only texts with such a window in
    several places are looked at for the ends of runs.
    """
    lines = written(numbered_lines(docs).dropDuplicates(["doc_id", "body", "pos"]), "lines")
    ahead = written(windows_ahead(lines, least_words), "windows")
    texts = written(_matched(ahead).select("doc_id", "body").distinct(), "matched-texts")
    found = _of_texts(ahead, texts).union(windows_back(_of_texts(lines, texts), least_words))
    places = _matched(written(found, "matched-windows"))
    elsewhere = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("body") == F.col("first.body")))
    later = places.where(elsewhere | (F.col("pos") > F.col("first.last")))
    return (
        later.select("doc_id", "body", F.explode(F.sequence("pos", "last")).alias("pos"))
        .groupBy("doc_id", "body").agg(F.collect_set("pos").alias("gone"))
    )


def line_dedup(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` with later repeated runs of lines taken out of text.

    A run is one line or more, of ``least_words`` words or more in all; lines without a word
    neither count nor part a run. Its first place by (doc_id, position) stays, a null
    doc_id before all others. A run that repeats within a text without a gap keeps its
    first copy whole. A column n_chars gets the new length. A column n_lines_removed is
    added, or replaced.

    Null texts stay null, empty ones empty; a text whose lines all go is empty. Rows with
    the same doc_id and text count as one place and lose the same lines; rows with one
    doc_id and different texts are texts of their own, in the order of a hash. An empty
    table gives an empty result.
    """
    gone = repeated_lines(docs, least_words).select(
        F.col("doc_id").alias("__doc_id"), F.col("body").alias("__body"), F.col("gone").alias("__gone")
    )
    joined = docs.join(
        gone,
        docs["doc_id"].eqNullSafe(F.col("__doc_id")) & (F.xxhash64(docs["text"]) == F.col("__body")),
        "left",
    )
    lines = F.split("text", "\n")
    # The lines to stay, as what is left when the lines to go are blanked by place.
    kept = F.filter(lines, lambda line, i: ~F.array_contains("__gone", i))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = joined.withColumn("text", text).withColumn(
        "n_lines_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long")
    )
    if "n_chars" in docs.columns:
        out = out.withColumn(
            "n_chars", F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
        )
    return out.select(*docs.columns, *(["n_lines_removed"] if "n_lines_removed" not in docs.columns else []))
