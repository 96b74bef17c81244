"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

Texts with equal shingle sets form one class, which a document stands for. Sketches of
classes are cut into bands; classes that share a band are candidates, and only pairs whose
full shingle sets are alike enough are linked. A bucket of many candidates is not compared
pair by pair: its members are first held against one of them, then only members that still
lie in different components, and have not too many shingles of their own for any link, are
held against each other. So large groups of copies cost their size, and no link between
two components is missed. Links found are kept as edges between components, and only new
ones are followed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablelift.llm.components import components
from tablelift.llm.sketches import band_keys, sketch_all
from tablelift.llm.tables import written
from tablelift.llm.words import mix, shingle_sets

# Bins of a band. 24 bands of 6 miss a pair of resemblance 0.85 once in 80,000 times.
ROWS = 6
PERCENT = 85
# A pair just alike enough may be missed once in so many times.
MISSED_ONCE_IN = 80_000
# Rounds that hold each bucket's members against one of them, before all that is left.
HUB_ROUNDS = 2


def bands_for(percent: int, rows: int = ROWS) -> int:
    """The fewest bands that miss a pair of this resemblance once in MISSED_ONCE_IN times or less."""
    alike = (percent / 100) ** rows
    return 1 if alike >= 1 else math.ceil(math.log(MISSED_ONCE_IN) / -math.log1p(-alike))


def _class_hash(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set of hashes."""
    with np.errstate(over="ignore"):
        a = mix(shingles).sum(dtype=np.uint64)
        b = mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def sketched(docs: DataFrame, bands: int, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, the class of the shingle set (two numbers) and its band keys."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()),
         ("keys", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column(1)):
                keys = band_keys(sketch_all(sets, bands * rows), bands, rows).astype(np.int64)
                classes = np.array([_class_hash(s) for s in sets], np.int64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), pa.array(keys.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(classes[:, 0]), pa.array(classes[:, 1]), lists],
                    schema=schema,
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_shingles long, c1 long, c2 long, keys array<long>")


def _packed_texts(texts: DataFrame) -> DataFrame:
    """node, size, body: compressed texts of nodes, as they are sent about with pairs.

    Of rows that share a doc_id, those with the node's own shingle set are taken.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            for first, sets in shingle_sets(batch["text"]):
                part = batch.slice(first, len(sets))
                wanted = zip(sets, part["c1"].to_pylist(), part["c2"].to_pylist())
                own = part.filter(pa.array([_class_hash(s) == (c1, c2) for s, c1, c2 in wanted], pa.bool_()))
                raw = [text.encode() for text in own["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [own["node"], pa.array([len(r) for r in raw], pa.int64()),
                     pa.array([codec.compress(r, asbytes=True) for r in raw], pa.binary())],
                    names=["node", "size", "body"],
                )

    return texts.mapInArrow(run, "node long, size long, body binary")


def verified(pairs: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` whose a and b have full shingle sets that share ``percent`` of their union.

    Other columns of ``pairs`` are kept.
    """
    kept = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                part = batch.slice(first, 200)
                sets = []
                for size, body in (("a_size", "a_body"), ("b_size", "b_body")):
                    packed = zip(part[body].to_pylist(), part[size].to_pylist())
                    texts = [codec.decompress(b, n, asbytes=True).decode() for b, n in packed]
                    sets.append([s for _, many in shingle_sets(pa.array(texts, pa.large_string())) for s in many])
                shared = [
                    len(a) + len(b) - len(np.unique(np.concatenate((a, b)))) for a, b in zip(*sets)
                ]
                alike = [
                    100 * n >= percent * (len(a) + len(b) - n) for n, a, b in zip(shared, *sets)
                ]
                yield part.filter(pa.array(alike, pa.bool_())).select(kept)

    def side(name: str) -> DataFrame:
        return bodies.select(
            F.col("node").alias(name), F.col("size").alias(f"{name}_size"), F.col("body").alias(f"{name}_body")
        )

    return pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").mapInArrow(run, pairs.schema)


def _joined_labels(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """node, component after ``edges`` (a, b) between components; nodes never linked have no row."""
    found = components(edges)
    if labels is None:
        return found
    moved = found.select(F.col("node").alias("component"), F.col("component").alias("top"))
    kept = labels.join(moved.hint("merge"), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    fresh = found.join(labels.select("node").hint("merge"), "node", "left_anti").select("node", "component")
    return written(kept.union(fresh), "labels")


def _may_link(n: Column, lone: Column, x_n: Column, x_lone: Column, percent: int) -> Column:
    """Sets of these sizes, with so many elements that no other set has, can be alike enough."""
    shared = F.least(n - lone, x_n - x_lone)
    return (100 + percent) * shared >= percent * (n + x_n)


def _unshared(bodies: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, lone: the number of a node's shingles that no other of ``nodes`` has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            packed = zip(batch["body"].to_pylist(), batch["size"].to_pylist())
            texts = pa.array([codec.decompress(b, n, asbytes=True).decode() for b, n in packed], pa.large_string())
            for first, sets in shingle_sets(texts):
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
                hashes = np.concatenate(sets).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes))
                yield pa.RecordBatch.from_arrays(
                    [batch["node"].slice(first, len(sets)), lists], names=["node", "shingles"]
                )

    sets = bodies.join(nodes, "node").select("node", "size", "body").mapInArrow(run, "node long, shingles array<long>")
    single = sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
    owned = single.agg(F.min("node").alias("node"), F.max("node").alias("other")).where("node = other")
    return owned.groupBy("node").agg(F.count("*").alias("lone"))


def _plausible(members: DataFrame, labels: DataFrame | None, bodies: DataFrame, percent: int) -> DataFrame:
    """Members of buckets that hold several components, but those that can link with none.

    A set's shingles that no other candidate has bound its resemblance to any of them. In
    a group of edited copies most of those too far from each other go by this bound, at
    the cost of counting their shingles and not of comparing them pair by pair.
    """
    now = _labelled(members, labels)
    spread = now.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    now = written(members.join(spread.where("low <> high").select("key"), "key"), "open-buckets")
    lone = _unshared(bodies, now.select("node").distinct())
    counted = now.drop("lone").join(lone.hint("merge"), "node", "left").fillna(0, ["lone"])
    least = now.groupBy("key").agg(F.min("n").alias("least"))
    shared = F.col("n") - F.col("lone")
    partner = F.greatest(F.col("least"), shared)
    able = 100 * shared >= percent * (F.col("n") + partner - shared)
    return written(counted.join(least, "key").where(able).drop("least"), "open-buckets")


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("component", F.col("node"))
    found = members.join(labels.hint("merge"), "node", "left")
    return found.withColumn("component", F.coalesce("component", "node"))


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, bands: int | None = None, rows: int = ROWS, hub_rounds: int = HUB_ROUNDS
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``.

    Documents are linked if 100 times the size of the intersection of their sets of
    five-word shingles is ``percent`` times that of the union or more; component_id is the
    smallest doc_id reachable over links, and kept tells whether it is the document's own.
    By default there are as many bands as ``bands_for`` the percentage.

    A text of one to four words has one shingle, all of them. Null texts and texts without
    words have none and are linked with nothing. Rows with a null doc_id are linked with
    nothing, have a null component_id and are kept. Rows with the same doc_id and text are
    alike in every column; rows of one doc_id with different texts are linked each by its
    own text. An empty table gives an empty result; other columns are ignored.
    """
    whole = written(sketched(docs, bands or bands_for(percent, rows), rows), "sketches")
    classes = written(
        whole.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("c1", "c2")
        .agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n")),
        "classes",
    )
    # One row stands for its class.
    chosen = whole.drop("n_shingles").join(classes, ["c1", "c2"]).where("doc_id = node").dropDuplicates(["c1", "c2"])
    banded = chosen.select("node", "n", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    members = written(banded.join(shared, "key").withColumn("lone", F.lit(0).cast("long")), "buckets")

    nodes = members.select("node").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    wanted = nodes.join(classes, "node").select("node", "c1", "c2")
    bodies = written(_packed_texts(texts.join(wanted, "node")), "candidates")

    labels = None
    for hub_round in range(hub_rounds + 1):
        if hub_round:
            members = _plausible(members, labels, bodies, percent)
        now = _labelled(members, labels)
        spread = now.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.min_by("node", F.xxhash64("node", F.lit(hub_round)) if hub_round else F.col("node")).alias("hub"),
        ).where("low <> high")
        hubs = spread.join(now.select("key", F.col("node").alias("hub"), F.col("n").alias("hub_n"),
                                      F.col("lone").alias("hub_lone"),
                                      F.col("component").alias("hub_component")), ["key", "hub"])
        apart = (F.col("component") != F.col("x_component")) & _may_link(
            F.col("n"), F.col("lone"), F.col("x_n"), F.col("x_lone"), percent
        )
        if hub_round < hub_rounds:
            sides = hubs.select("key", F.col("hub").alias("x"), F.col("hub_n").alias("x_n"),
                                F.col("hub_lone").alias("x_lone"), F.col("hub_component").alias("x_component"))
        else:
            # Every member outside the hub's component against all of the bucket; two that
            # share several buckets, or are both outside, meet once.
            keys = members.groupBy("node").agg(F.collect_set("key").alias("keys"))
            now = now.join(keys, "node")
            sides = now.join(hubs.select("key", "hub_component"), "key").where("component <> hub_component")
            sides = sides.select("key", F.col("node").alias("x"), F.col("n").alias("x_n"), F.col("lone").alias("x_lone"),
                                 F.col("component").alias("x_component"), F.col("keys").alias("x_keys"), "hub_component")
            apart = apart & ((F.col("component") == F.col("hub_component")) | (F.col("node") > F.col("x")))
            apart = apart & (F.array_min(F.array_intersect("keys", "x_keys")) == F.col("key"))
        found = now.join(sides, "key").where(apart)
        if hub_round == 0 < hub_rounds:
            # Each node against the one hub that it shares most buckets with: most are linked
            # by that, and in a group of very many copies none by a link for every bucket.
            alike = found.groupBy("node", "x", "component", "x_component").agg(F.count("*").alias("buckets"))
            best = F.max_by(F.struct("x", "component", "x_component"), F.struct("buckets", -F.col("x")))
            found = alike.groupBy("node").agg(best.alias("best")).select("node", "best.*")
        pairs = found.select(
            F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b"),
            F.least("component", "x_component").alias("c"), F.greatest("component", "x_component").alias("d"),
        ).distinct()
        # What links two components many times over is one edge between them.
        edges = verified(pairs, bodies, percent).select(F.col("c").alias("a"), F.col("d").alias("b")).distinct()
        edges = written(edges, "links")
        if not edges.isEmpty():
            labels = _joined_labels(labels, edges)
    final = classes.select("c1", "c2", "node")
    final = _labelled(final, labels).select("c1", "c2", "component")
    out = whole.select("doc_id", "n_shingles", "c1", "c2").join(final, ["c1", "c2"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )



def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near copies: one row of each group, with its columns.

    Groups are those of ``near_duplicates``, but of rows and not of ids: rows with a null
    doc_id or with one that other rows have are grouped by their texts like all others. The
    row with the smallest doc_id stays, a null one after all others. Rows without words are
    in no group and all stay.
    """
    # Rows get keys, which must be the same each time they are read.
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), percent)
    groups = found.where("NOT kept").select(F.col("component_id").alias("group")).distinct()
    grouped = found.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("group"))
    members = grouped.join(groups, "group").join(rows.select("__row", "doc_id"), "__row")
    members = written(members, "group-rows")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row"))
    stay = members.groupBy("group").agg(F.min_by("__row", order).alias("__row")).select("__row")
    copies = members.select("__row").join(stay, "__row", "left_anti")
    return rows.join(copies, "__row", "left_anti").select(*docs.columns)
