"""Connected components of an edge table by repeated contraction.

Every round each node moves to the neighbour of least random priority (its own included) and the edges are rewritten
to the nodes moved to, so a constant share of the nodes disappears per round whatever the shape of the graph; long
chains and large stars included. Minima are aggregated before they are shuffled and the rewriting is an equi-join, so
a node with very many links is split by adaptive execution instead of landing in one task. All round tables are
written to the shared folder. Once the contracted graph is below a fixed number of edges one task finishes it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomark.llm._common import materialize

FINISH_EDGES = 200_000


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Root (least index) of each of ``n`` nodes under the links ``a[i] - b[i]``; vectorised hooking and jumping."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            break
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    frames = list(batches)
    if not frames:
        return
    edges = pd.concat(frames)
    nodes, inverse = np.unique(np.concatenate([edges["u"].to_numpy(), edges["v"].to_numpy()]), return_inverse=True)
    half = len(edges)
    root = local_roots(inverse[:half], inverse[half:], len(nodes))
    yield pd.DataFrame({"node": nodes, "to": nodes[root]})


def connected_components(edges: DataFrame, finish_edges: int = FINISH_EDGES, max_rounds: int = 60) -> DataFrame:
    """``edges(u long, v long)`` → ``(node long, root long)`` for every node that has a link to another node.

    Repeated edges, both directions, loops and nulls are allowed; loops and nulls are left out. The root is an
    arbitrary member of the component, the same for all of them. No edges: no rows.
    """
    current = materialize(edges.where("u is not null and v is not null and u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "cc-edges")
    maps: list[DataFrame] = []
    while True:
        count = current.count()
        if count <= finish_edges:
            last = current.repartition(1).mapInPandas(_finish, "node long, to long")
            break
        if len(maps) >= max_rounds:
            raise RuntimeError(f"components: {count} edges left after {max_rounds} rounds")
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(maps)), c).alias("p"), c.alias("id"))
        least = both.groupBy("u").agg(F.min(rank(F.col("v"))).alias("m"))
        moved = materialize(least.select(F.col("u").alias("node"), F.least("m", rank(F.col("u")))["id"].alias("to")), f"cc-map-{len(maps)}")
        a, b = moved.select(F.col("node").alias("u"), F.col("to").alias("nu")), moved.select(F.col("node").alias("v"), F.col("to").alias("nv"))
        rewritten = current.join(a, "u").join(b, "v").where("nu <> nv")
        maps.append(moved)
        current = materialize(rewritten.select(F.least("nu", "nv").alias("u"), F.greatest("nu", "nv").alias("v")).distinct(), f"cc-edges-{len(maps)}")
    labels = last
    for moved in reversed(maps):
        down = labels.select(F.col("node").alias("to"), F.col("to").alias("root"))
        labels = moved.join(down, "to", "left").select("node", F.coalesce("root", "to").alias("to"))
    return labels.select("node", F.col("to").alias("root"))
