import math

import brute
import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm import components, embeddings, queries

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()),
                        T.StructField("embedding", T.ArrayType(T.FloatType()))])


def groups(spark, rows, **kw):
    df = spark.createDataFrame(rows, VECTORS)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.embedding_groups(df, **kw).collect()}


def expected(rows, threshold=0.9):
    vecs = {i: np.array(v, float) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}

    def linked(a, b):
        if a not in vecs or b not in vecs or len(vecs[a]) != len(vecs[b]):
            return False
        x, y = vecs[a], vecs[b]
        return float(x @ y) / math.sqrt(float(x @ x) * float(y @ y)) >= threshold

    ids = [i for i, _ in rows]
    comp = brute.groups(ids, linked)
    return {i: (sum(linked(i, j) for j in ids if j != i), comp[i], comp[i] == i) for i in ids}


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = [(i, (centres[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.05, 0.2, 0.45])).astype("f4").tolist())
            for i in range(n)]
    return rows + [(n + i, rows[i % 5][1]) for i in range(20)]  # equal vectors


def test_links_and_components_equal_brute_force(spark, monkeypatch):
    rows = clustered(300, 16, 1)
    assert groups(spark, rows) == expected(rows)
    monkeypatch.setattr(embeddings, "HOME_BLOCK", 20)  # many cells, and cells of several blocks
    monkeypatch.setattr(embeddings, "MEMBER_BLOCK", 16)
    assert groups(spark, rows, margin=None) == expected(rows)


def links_of(spark, rows, **kw):
    return sum(n for n, _, _ in groups(spark, rows, **kw).values())


def planted(n, dim, cosines, seed):
    """Random vectors, a third of them with a partner at a cosine from ``cosines``."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = rng.normal(size=(n // 3, dim))
    g -= (g * x[:n // 3]).sum(axis=1, keepdims=True) * x[:n // 3]
    g /= np.linalg.norm(g, axis=1, keepdims=True)
    c = rng.choice(cosines, size=(n // 3, 1))
    return np.concatenate([x, c * x[:n // 3] + np.sqrt(1 - c * c) * g])


def pair_counts(x):
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    return near.sum(axis=1)


def test_default_margin_recall_and_symmetric_counts(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "HOME_BLOCK", 40)  # 50 cells
    monkeypatch.setattr(embeddings, "MEMBER_BLOCK", 64)
    x = planted(1500, 64, [0.91, 0.95, 0.99], 3)
    got = groups(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    counts, want = np.array([got[i][0] for i in range(len(x))]), pair_counts(x)
    assert (counts <= want).all() and counts.sum() >= 0.9 * want.sum()
    partner = np.arange(500)  # both ends of a pair count it, or neither does
    assert (counts[partner] == counts[1500 + partner]).all()
    assert all(got[1500 + i][1] == (i if counts[i] else 1500 + i) for i in range(500))


def test_visits_do_not_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "HOME_BLOCK", 20)
    seen = []
    for n in (600, 4800):
        x = np.random.default_rng(n).normal(size=(n, 64))
        df = spark.createDataFrame([(i, 1, v.tobytes()) for i, v in enumerate(x)], "rep long, mult long, vec binary")
        rows = embeddings.cells_of(df)
        assert rows.filter("home = 1").count() == n
        seen.append(rows.count() / n)
    assert max(seen) <= embeddings.MAX_VISITS


def test_two_levels_index_every_vector_once(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "HOME_BLOCK", 20)
    monkeypatch.setattr(embeddings, "MEMBER_BLOCK", 64)
    monkeypatch.setattr(embeddings, "MAX_CELLS", 12)  # 100 cells are wanted
    x = planted(1500, 64, [0.92, 0.99], 5)
    df = spark.createDataFrame([(i, 1, v.tobytes()) for i, v in enumerate(x)], "rep long, mult long, vec binary")
    rows = embeddings.cells_of(df).collect()
    assert sorted(r.rep for r in rows if r.home) == list(range(len(x)))
    assert len({r.at for r in rows}) > 40 and all(r.cell in r.visits and r.at == r.cell for r in rows if r.home)
    got = groups(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    counts, want = np.array([got[i][0] for i in range(len(x))]), pair_counts(x)
    assert (counts <= want).all() and counts.sum() >= 0.9 * want.sum()
    assert (counts[:500] == counts[1500:]).all()
    # one cell may hold nearly everything
    same = np.array([1.0] + [0.0] * 63) + 0.01 * np.random.default_rng(6).normal(size=(400, 64))
    same /= np.linalg.norm(same, axis=1, keepdims=True)
    assert links_of(spark, [(i, v.tolist()) for i, v in enumerate(same)], margin=None) == pair_counts(same).sum()
    assert links_of(spark, [(i, v.tolist()) for i, v in enumerate(same)]) >= 0.9 * pair_counts(same).sum()


def test_edge_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [float("inf"), 1.0]),
            (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0]), (10, [3.0]), (11, [1e30, 0.0]), (12, [0.0, -1.0])]
    assert groups(spark, rows) == expected(rows)
    assert groups(spark, []) == {}
    assert groups(spark, rows[:3]) == {1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True)}


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])], VECTORS)
    for name in ("rep", "vec", "cell", "component_id", "n_links"):
        df = df.withColumn(name, F.lit("x"))
    got = sorted(embeddings.embedding_groups(df).collect(), key=str)
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in got] == [
        (1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False)]


def test_query_on_the_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op1_embedding_near_dedup(spark, sf_dir).collect()}
    assert got == expected([(r.vec_id, r.embedding) for r in table])


def test_components_on_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(300, 300), (301, None)]
    got = {r.id: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute.groups(sorted(got), lambda a, b: (a, b) in edges or (b, a) in edges)
    assert set(got) == set(range(61)) | set(range(100, 150)) | {200, 201, 202}
    by_label = {}
    for i, label in got.items():
        by_label.setdefault(label, set()).add(want[i])
    assert all(len(s) == 1 for s in by_label.values()) and len(by_label) == 3
