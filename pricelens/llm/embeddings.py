"""Embedding near-dedup: spherical k-means cells and blocked cosine products.

Equal vectors are joined first. Spherical k-means (Lloyd rounds over
``FIT_PER_CELL`` vectors a cell, drawn by hash; the start is ``k`` vectors
with the smallest hashes) gives cells in proportion to the vectors. Beyond
``MAX_CELLS`` cells there are two levels: the cells of the first are split by
spherical k-means of their own, and only the first level's centroids pass
through the driver. Every vector is at home in the cell of its nearest centroid
and visits the next cells whose cosine is within ``margin`` of the nearest one,
``MAX_VISITS`` at most, so its work does not grow with the table. A vector is
compared with the home vectors of all its cells; a pair that meets in one
direction only is counted for both.

Every vector is indexed and every link found is checked in double precision;
a link is lost only if neither vector visits the other's home. With
``margin=None`` none is: a vector then visits each cell in which a vector
within the angle could be at home (the cell's half-space must come within
``acos(threshold)`` of it, an exact bound), which in many dimensions is nearly
every cell.

A unit of work is one block of home vectors and one block of members of the
same cell, both bounded, whatever the cell's size; its product returns link
counts and a spanning forest of the links, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import components, local_labels

THRESHOLD = 0.9
HOME_BLOCK = 4096
MEMBER_BLOCK = 8192
MAX_CELLS = 4096  # cells of one level; beyond its square cells grow and are cut into more blocks
ROUNDS = 4
FIT_PER_CELL = 512  # vectors a cell that the centroids are fitted on
MARGIN = 0.15
MAX_VISITS = 12
TOP_VISITS = 4  # cells of the first level that a vector looks into, where there are two

CELLS = "rep bigint, mult bigint, vec binary, cell bigint, home int, at bigint, visits array<bigint>"


def _matrix(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<f8").reshape(len(column), -1)


def _pack(batches):
    """Vectors as bytes of doubles; NULL, empty, zero and non-finite ones get none."""
    for batch in batches:
        vecs = []
        for v in batch.column("vec").to_pylist():
            x = np.array([np.nan if e is None else e for e in v] if v else [0.0], np.float64)
            vecs.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(vecs, pa.binary())], ["id", "vec"])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _centroid_sums(centroids: np.ndarray):
    def run(batches):
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            x = _unit(_matrix(batch.column("vec"))) if len(batch) else centroids[:0]
            near = (x @ centroids.T).argmax(axis=1)
            np.add.at(sums, near, x)
            counts += np.bincount(near, minlength=len(centroids))
        has = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(has.astype(np.int64)), pa.array([s.tolist() for s in sums[has]], pa.list_(pa.float64()))],
            ["cell", "sums"])

    return run


def _lloyd(centroids: np.ndarray, sums: np.ndarray) -> np.ndarray:
    good = np.abs(sums).max(axis=1) > 1e-12
    centroids = centroids.copy()
    centroids[good] = _unit(sums[good])
    return centroids


def _apart(centroids: np.ndarray, merge: float) -> np.ndarray:
    """The centroids without those within cosine ``merge`` of an earlier one.

    A group of near copies with a large share of the rows draws many
    centroids; left in place they would scatter its links over many cells.
    """
    kept = np.zeros(len(centroids), bool)
    for i in range(len(centroids)):
        kept[i] = not (centroids[kept] @ centroids[i] >= merge).any()
    return centroids[kept]


def _drawn(share):
    """Whether the vector's hash falls into ``share`` of all hashes."""
    return F.pmod(F.xxhash64("vec", F.lit(7)), F.lit(1 << 40)) < share * float(1 << 40)


def spherical_kmeans(vectors: DataFrame, k: int, n: int, merge: float, rounds: int = ROUNDS) -> np.ndarray:
    """At most ``k`` unit centroids of ``n`` vectors, none within ``merge`` of another; the driver holds k rows."""
    start = vectors.orderBy(F.xxhash64("vec"), "vec").limit(k).select("vec").toArrow()
    centroids = _apart(_unit(_matrix(start.column("vec").combine_chunks())), merge)
    fit = vectors.filter(_drawn(F.lit(FIT_PER_CELL * k / n))).select("vec")
    for _ in range(rounds if len(centroids) > 1 else 0):
        part = fit.mapInArrow(_centroid_sums(centroids), "cell bigint, sums array<double>")
        part = part.select("cell", F.posexplode("sums").alias("d", "x")).groupBy("cell", "d").agg(F.sum("x").alias("x"))
        got = part.toPandas()
        sums = np.zeros_like(centroids)
        sums[got["cell"].to_numpy(), got["d"].to_numpy()] = got["x"].to_numpy()
        centroids = _lloyd(centroids, sums)
    return _apart(centroids, merge)


def _near_cells(cos: np.ndarray, margin: float, visits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's largest cosines within ``margin`` of its best, at most ``visits``."""
    visits = min(visits, cos.shape[1])
    best = np.argpartition(-cos, visits - 1, axis=1)[:, :visits]
    taken = np.take_along_axis(cos, best, axis=1)
    row, at = np.nonzero(taken >= taken.max(axis=1, keepdims=True) - margin)
    return row, best[row, at]


def _assign(centroids: np.ndarray, threshold: float, margin: float | None, visits: int):
    """Home cell (``home`` 1) and visited cells (``home`` 0) of each vector.

    ``at`` is the vector's home in every row; its home row holds all its cells
    in ``visits``, unless the bound is exact, when pairs meet both ways.
    """
    reach = np.sqrt(max(0.0, 1 - threshold * threshold)) + 1e-9
    gap = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0)) if margin is None else None

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            cos = _unit(_matrix(batch.column("vec"))) @ centroids.T
            home = cos.argmax(axis=1)
            if margin is None:
                # distance to the half-space in which the other centroid is nearer
                row, cell = np.nonzero(cos.max(axis=1)[:, None] - cos <= reach * gap[home] + 1e-12)
                lists = pa.nulls(len(row), pa.list_(pa.int64()))
            else:
                row, cell = _near_cells(cos, margin, visits)
                ends = np.searchsorted(row, np.arange(len(batch) + 1))
                lists = pa.array([cell[ends[r]:ends[r + 1]].tolist() if home[r] == c else None
                                  for r, c in zip(row.tolist(), cell.tolist())], pa.list_(pa.int64()))
            pick = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(pick), batch.column("mult").take(pick), batch.column("vec").take(pick),
                 pa.array(cell.astype(np.int64)), pa.array((home[row] == cell).astype(np.int32)),
                 pa.array(home[row].astype(np.int64)), lists],
                ["rep", "mult", "vec", "cell", "home", "at", "visits"])

    return run


def _split_cell(merge: float):
    """Centroids of the parts of one first-level cell, from its drawn vectors."""
    def run(table: pa.Table) -> pa.Table:
        x = np.unique(_unit(_matrix(table.column("vec").combine_chunks())), axis=0)
        k = min(len(x), table.column("parts")[0].as_py())
        centroids = _apart(x[np.random.default_rng(k).choice(len(x), k, replace=False)], merge)
        for _ in range(ROUNDS if len(centroids) > 1 else 0):
            sums = np.zeros_like(centroids)
            for at in range(0, len(x), 1024):
                np.add.at(sums, (x[at:at + 1024] @ centroids.T).argmax(axis=1), x[at:at + 1024])
            centroids = _lloyd(centroids, sums)
        centroids = _apart(centroids, merge)
        k = len(centroids)
        return pa.table({"cell": pa.array([table.column("cell")[0].as_py()] * k, pa.int64()),
                         "part": pa.array(range(k), pa.int64()),
                         "centroid": pa.array([c.tobytes() for c in centroids], pa.binary())})

    return run


def _near_parts(margin: float):
    def run(rows: pa.Table, parts: pa.Table) -> pa.Table:
        if not len(rows) or not len(parts):
            return pa.table({"rep": pa.array([], pa.int64()), "mult": pa.array([], pa.int64()),
                             "vec": pa.array([], pa.binary()), "cell": pa.array([], pa.int64()),
                             "cos": pa.array([], pa.float64())})
        cos = _unit(_matrix(rows.column("vec").combine_chunks())) @ _matrix(parts.column("centroid").combine_chunks()).T
        row, part = _near_cells(cos, margin, MAX_VISITS)
        pick = pa.array(row)
        cell = parts.column("cell").to_numpy() * MAX_CELLS + parts.column("part").to_numpy()
        return pa.table({"rep": rows.column("rep").take(pick), "mult": rows.column("mult").take(pick),
                         "vec": rows.column("vec").take(pick), "cell": pa.array(cell[part]),
                         "cos": pa.array(cos[row, part])})

    return run


def _two_levels(vectors: DataFrame, n: int, threshold: float, margin: float) -> DataFrame:
    """The rows of ``_assign`` for cells that are parts of ``MAX_CELLS`` first-level cells.

    A vector is scored against the parts of its nearest first-level cells, in
    bounded blocks; its home is the best part of all, its visits the next.
    """
    top = spherical_kmeans(vectors, MAX_CELLS, n, threshold)
    near = staged(vectors.mapInArrow(_assign(top, threshold, margin, TOP_VISITS), CELLS), "top-cells")
    sizes = staged(near.groupBy("cell").agg(F.sum("home").alias("homes"), F.count("*").alias("rows")).select(
        "cell", "homes", F.ceil(F.col("rows") / MEMBER_BLOCK).cast("int").alias("blocks"),
        F.least(F.lit(MAX_CELLS), F.ceil(F.col("homes") / HOME_BLOCK)).cast("int").alias("parts")), "top-sizes")
    homes = near.filter("home = 1").join(F.broadcast(sizes), "cell")  # at most MAX_CELLS rows
    one = homes.groupBy("cell", "parts").agg(F.min("vec").alias("vec")).select("cell", "parts", "vec")
    drawn = homes.filter(_drawn(F.lit(float(FIT_PER_CELL)) * F.col("parts") / F.col("homes"))).select("cell", "parts", "vec")
    parts = staged(drawn.unionAll(one).groupBy("cell").applyInArrow(
        _split_cell(threshold), "cell bigint, part bigint, centroid binary"), "cell-parts")
    blocks = parts.join(F.broadcast(sizes), "cell").select(
        "cell", "part", "centroid", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    rows = near.join(F.broadcast(sizes), "cell").select(
        "cell", "rep", "mult", "vec", F.pmod(F.xxhash64("rep", F.lit(3)), "blocks").cast("int").alias("block"))
    scored = rows.groupBy("cell", "block").cogroup(blocks.groupBy("cell", "block")).applyInArrow(
        _near_parts(margin), "rep bigint, mult bigint, vec binary, cell bigint, cos double")
    # a vector has at most TOP_VISITS * MAX_VISITS scores
    own = scored.groupBy("rep").agg(
        F.any_value("mult").alias("mult"), F.any_value("vec").alias("vec"),
        F.reverse(F.array_sort(F.collect_list(F.struct("cos", "cell")))).alias("scores"))
    own = own.withColumn("visits", F.transform(F.slice(F.filter(
        "scores", lambda s: s["cos"] >= F.col("scores")[0]["cos"] - margin), 1, MAX_VISITS), lambda s: s["cell"]))
    own = own.select("rep", "mult", "vec", F.col("visits")[0].alias("at"), "visits", F.explode("visits").alias("cell"))
    home = F.col("cell") == F.col("at")
    return own.select("rep", "mult", "vec", "cell", home.cast("int").alias("home"), "at",
                      F.when(home, F.col("visits")).alias("visits"))


def _missed(visits: list, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``lone[h, code]``: home row ``h`` does not visit a member's home; and each member's code."""
    cells, code = np.unique(at, return_inverse=True)
    lone = np.ones((len(visits), len(cells)), bool)
    row = np.repeat(np.arange(len(visits)), [len(v) for v in visits])
    cell = np.array([c for v in visits for c in v], np.int64)
    place = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
    known = cells[place] == cell
    lone[row[known], place[known]] = False
    return lone, code


def _block_links(threshold: float, both_ways: bool):
    def run(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        x = _unit(_matrix(table.column("vec").combine_chunks()))
        rep, mult = table.column("rep").to_numpy(), table.column("mult").to_numpy()
        h, m = np.nonzero(role == 0)[0], np.nonzero(role == 1)[0]
        n_links, lab, homes = np.zeros(len(rep), np.int64), np.arange(len(rep)), x[h].T
        if not both_ways and len(h) and len(m):
            lone, code = _missed(table.column("visits").take(pa.array(h)).to_pylist(), table.column("at").to_numpy()[m])
        for at in range(0, len(m), 512):
            rows = m[at:at + 512]
            near = (x[rows] @ homes >= threshold) & (rep[rows][:, None] != rep[h][None, :])
            n_links[rows] += near @ mult[h]
            i, j = np.nonzero(near)
            if not both_ways and len(i):
                once = lone[j, code[at + i]]  # the home row does not meet this member elsewhere
                np.add.at(n_links, h[j[once]], mult[rows[i[once]]])
            lab = local_labels(len(rep), rows[i], h[j], lab)
        linked = n_links > 0
        away = np.nonzero((lab != np.arange(len(rep))) & (rep != rep[lab]))[0]
        n = int(linked.sum())
        return pa.table({
            "a": pa.array(np.concatenate([rep[linked], rep[away]])),
            "n": pa.array(np.concatenate([n_links[linked], np.zeros(len(away), np.int64)])),
            "b": pa.array([None] * n + rep[lab[away]].tolist(), pa.int64()),
        })

    return run


def cells_of(vectors: DataFrame, threshold: float = THRESHOLD, margin: float | None = MARGIN) -> DataFrame:
    """Each distinct vector once per cell that it is at home in or visits (``CELLS``)."""
    n = vectors.count()
    k = max(1, -(-n // HOME_BLOCK))
    if k > MAX_CELLS and margin is not None:
        return staged(_two_levels(vectors, n, threshold, margin), "cells")
    centroids = spherical_kmeans(vectors, min(k, MAX_CELLS), max(n, 1), threshold)
    return staged(vectors.mapInArrow(_assign(centroids, threshold, margin, MAX_VISITS), CELLS), "cells")


def _links(vectors: DataFrame, threshold: float, margin: float | None) -> DataFrame:
    """``a, n, b``: link counts of ``a`` (b NULL), and forest edges a-b, for one dimension."""
    cells = cells_of(vectors, threshold, margin)
    sizes = cells.groupBy("cell").agg(
        F.ceil(F.sum("home") / HOME_BLOCK).cast("int").alias("nh"),
        F.ceil(F.count("*") / MEMBER_BLOCK).cast("int").alias("nm")).filter("nh > 0")
    met = cells.join(sizes, "cell")
    own = lambda seed, n: F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(n)).cast("int")
    homes = met.filter("home = 1").select(
        "cell", own(1, "nh").alias("hb"), F.explode(F.sequence(F.lit(0), F.col("nm") - 1)).alias("mb"),
        F.lit(0).alias("role"), "rep", "mult", "vec", "at", "visits")
    members = met.select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("nh") - 1)).alias("hb"), own(2, "nm").alias("mb"),
        F.lit(1).alias("role"), "rep", "mult", "vec", "at", F.lit(None).cast("array<bigint>").alias("visits"))
    return (homes.unionAll(members).groupBy("cell", "hb", "mb")
            .applyInArrow(_block_links(threshold, margin is None), "a bigint, n bigint, b bigint"))


def embedding_groups(table: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id",
                     embedding: str = "embedding", margin: float | None = MARGIN) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row, links at cosine >= threshold.

    ``margin`` says how far beyond its nearest cell a vector looks for links;
    ``None`` finds every link, at a cost close to all pairs.

    A vector that is NULL, empty, zero or not finite links with nothing, nor
    do vectors of different lengths. Equal vectors link with each other;
    repeated rows count as rows. A NULL id never names a component that has
    another id (``kept`` is then false). An empty table gives no rows.
    """
    slim = table.select(F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("vec"))
    rows = staged(slim.mapInArrow(_pack, "id bigint, vec binary"), "vectors")
    distinct = rows.filter("vec IS NOT NULL").groupBy("vec").agg(
        F.min("id").alias("first"), F.count("*").alias("mult"))
    distinct = staged(distinct.withColumn("rep", F.monotonically_increasing_id()), "vectors-distinct")
    found = None
    for r in distinct.groupBy(F.length("vec").alias("size")).agg(F.lit(1)).collect():  # the dimensions
        part = _links(distinct.filter(F.length("vec") == r["size"]), threshold, margin)
        found = part if found is None else found.unionAll(part)
    if found is None:
        none = rows.select("id").withColumn("n_links", F.lit(0).cast("bigint"))
        return none.select(F.col("id").alias(vec_id), "n_links", F.col("id").alias("component_id"),
                           F.col("id").isNotNull().alias("kept"))
    found = staged(found, "vector-links")
    counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    labels = components(found.filter("b IS NOT NULL").select("a", "b"))
    named = distinct.join(labels, distinct["rep"] == labels["id"], "left").select(
        "rep", "vec", "first", "mult", F.coalesce("label", "rep").alias("label"))
    smallest = staged(named.groupBy("label").agg(F.min("first").alias("component_id")), "vector-smallest")
    counts = staged(counts, "vector-counts")
    named = named.join(smallest, "label").join(counts, named["rep"] == counts["a"], "left")
    named = staged(named.select("vec", (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                                "component_id"), "vector-groups")
    met = rows.select("id", "vec").join(named, "vec", "left")
    component = F.when(F.col("vec").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return met.select(F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
