"""Connected components by contraction, for graphs that no single machine holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sievespark.session import cut_lineage, drop

#: Links held before a map task contracts and passes them on.
HELD = 1 << 20


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for every node that is not the smallest."""
    ids, inverse = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = inverse[: len(u)], inverse[len(u) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for ends in (x, y, label[x], label[y]):
            np.minimum.at(new, ends, low)
        while (ahead := new[new]).tobytes() != new.tobytes():
            new = ahead
        if (new == label).all():
            break
        label = new
    some = label != np.arange(len(ids))
    return ids[some], ids[label[some]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0).to_numpy(), batch.column(1).to_numpy()


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links as stars to the smallest node that the task has seen: no node keeps more than one a block."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        u, v = stars(*(np.concatenate(c) for c in zip(*held)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["hi", "lo"])

    for pair in _links(batches):
        held.append(pair)
        if sum(len(u) for u, _ in held) > HELD:
            yield flush()
    if held:
        yield flush()


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links of a ``hi`` node are in one task: it is hooked for good; what ties other nodes stays a link."""
    own, u, v = (np.zeros(0, np.int64) for _ in range(3))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def settle() -> None:
        nonlocal own, u, v
        hi, lo = (np.concatenate(c) for c in zip(*held))
        held.clear()
        own = np.union1d(own, hi)
        u, v = stars(np.concatenate([u, hi]), np.concatenate([v, lo]))

    for pair in _links(batches):
        held.append(pair)
        n += len(pair[0])
        if n > max(HELD, len(u)):  # what is held doubles, so all contractions together are a few passes
            settle()
            n = 0
    if held:
        settle()
    if len(u):
        yield pa.RecordBatch.from_arrays([pa.array(~np.isin(u, own)), pa.array(u), pa.array(v)], ["link", "id", "to"])


def _followed(hooks: DataFrame) -> DataFrame:
    """Hooks (id -> to) followed to their ends, by doubling. Written; ``hooks`` may then go."""
    first = hooks
    while True:
        ahead = hooks.select(F.col("id").alias("to"), F.col("to").alias("far"))
        seen = Observation()
        longer = cut_lineage(hooks.join(ahead, "to", "left").observe(seen, F.count("far").alias("n")).select("id", F.coalesce("far", "to").alias("to")))
        if hooks is not first:
            drop(hooks)
        if not seen.get.get("n"):
            return longer
        hooks = longer


def compose(first: DataFrame, then: DataFrame) -> DataFrame:
    """(id, comp) of two contractions, the second over what the first left."""
    moved = first.join(then.select(F.col("id").alias("comp"), F.col("comp").alias("far")), "comp", "left").select("id", F.coalesce("far", "comp").alias("comp"))
    return moved.unionByName(then.select("id", "comp"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, comp) for every node of ``edges`` but the smallest of its component, which is ``comp``.

    A round contracts the links inside each task, deals them by their larger end and hooks every
    larger end to the smallest node its task knows for it. What still ties the others is relabelled
    and goes into the next round. A hub has one row a task at most; lookups are joins that adaptive
    execution may split. Links of a node with itself count for nothing; no edges, no rows.
    """
    links, rounds, old = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo"), [], []
    while True:
        seen = Observation()
        dealt = links.mapInArrow(_contracted, "hi long, lo long").repartition("hi").mapInArrow(_settled, "link boolean, id long, to long")
        table = cut_lineage(dealt.observe(seen, F.count_if("link").alias("n")))
        hooks = _followed(table.where("not link").select("id", "to"))
        rounds.append(hooks.withColumnRenamed("to", "comp"))
        old += [table, hooks]
        if not seen.get.get("n"):
            break
        for end in ("id", "to"):
            known = hooks.select(F.col("id").alias("known"), F.col("to").alias("root"))
            table = table.where("link").join(known, F.col(end) == F.col("known"), "left").withColumn(end, F.coalesce("root", end)).drop("known", "root")
        links = table.select(F.greatest("id", "to").alias("hi"), F.least("id", "to").alias("lo")).where("hi <> lo")
    labels = rounds.pop()
    while rounds:
        labels = compose(rounds.pop(), labels)
    labels = cut_lineage(labels)
    drop(*old)
    return labels
