"""Connected components by repeated contraction, as DataFrame jobs.

Each round sends every vertex to the smallest vertex (in a fixed random order)
of its closed neighbourhood and contracts the edges; self loops and repeats
go. Links stay in Spark; the driver sees only whether edges are left. The
minima are combined map-side and the two joins are plain ones, which AQE may
split on a vertex with very many edges.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _order(v: str):
    return F.xxhash64(F.lit(17), F.col(v))


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` (bigint) -> ``id, label``: equal labels for connected ids.

    ``label`` is one of the component's ids, not always the smallest. NULL
    ends and self loops are ignored; no edges give no rows.
    """
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    tidy = lambda df: df.filter("a <> b").select(*ends).distinct()
    e = staged(tidy(edges.select("a", "b")), "edges")
    maps: list[DataFrame] = []
    while not e.isEmpty():
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select("b", "a"))
        best = both.groupBy("u").agg(F.min(F.struct(_order("v").alias("o"), F.col("v"))).alias("m"))
        own = F.struct(_order("u").alias("o"), F.col("u").alias("v"))
        parent = staged(best.select("u", F.least(own, F.col("m"))["v"].alias("p")), "parents")
        pa = parent.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        pb = parent.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        moved = e.join(pa, "a").join(pb, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        e = staged(tidy(moved), "edges")
        maps.append(parent)
    if not maps:
        return e.select(F.col("a").alias("id"), F.col("b").alias("label"))
    last = maps.pop()
    for m in reversed(maps):
        up = last.select(F.col("u").alias("q"), F.col("p").alias("top"))
        last = staged(m.join(up, m["p"] == up["q"], "left").select("u", F.coalesce("top", "p").alias("p")), "labels")
    return last.select(F.col("u").alias("id"), F.col("p").alias("label"))


def local_labels(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Smallest index reachable by the edges (a, b) among ``n`` vertices of one block."""
    lab = np.arange(n) if labels is None else labels
    while len(a):
        x, y = lab[a], lab[b]
        differ = x != y
        if not differ.any():
            break
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(lab, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = lab[lab]
            if (up == lab).all():
                break
            lab = up
    return lab
