"""Connected components of a link table, by alternating large and small stars; those of few links in one task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import cut, released

#: At most so many links (16 bytes each) go to one task.
FEW = 1 << 20


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links a[i], b[i] and for each the least node that links reach."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    one, other, least = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while ((x := least[one]) != (y := least[other])).any():
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while ((up := least[least]) != least).any():
            least = up
    return nodes, nodes[least]


def _solved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads all links (a, b); gives node, component."""
    held = [[x.to_numpy(zero_copy_only=False) for x in batch.columns] for batch in batches]
    ends = [np.concatenate([np.empty(0, np.int64), *side]) for side in (zip(*held) if held else ((), ()))]
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in least_reached(*ends)], names=["node", "component"])


def _large_star(links: DataFrame) -> DataFrame:
    """Every node of links (a, b), a > b, hangs its higher neighbours under the least of its neighbours and itself.

    The least is summed up before the shuffle and joined back, so the links of a hub can be split over tasks.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hangs itself and its lower neighbours under the least of them; a node has as many as hubs met it."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    lower = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame, rounds: int = 60, few: int = FEW) -> DataFrame:
    """node, component (the least node of its component) for every node of links (a, b); longs, links in either direction.

    Up to `few` links are solved in one task. Of more each round is written to the shared folder; only a count and
    a checksum come to the driver. Rounds grow with the logarithm of the longest chain. Self-links and null ends
    are ignored. What the driver keeps of every job, stage and task it has run makes rounds dear for small tables.
    """
    links = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    if links.count() <= few:
        found = cut(links.coalesce(1).mapInArrow(_solved, "node long, component long"))
        released(links)
        return found
    old, links = links, cut(links.distinct())
    released(old)
    sign = None
    for _ in range(rounds):
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == sign or not now[0]:
            break
        sign = tuple(now)
        old, links = links, cut(_small_star(_large_star(links)))
        released(old)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = cut(links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
    released(links)
    return found
