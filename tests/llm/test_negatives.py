"""Hard negatives against all scores, on awkward rows; bounds and windows of the index."""

import collections
import math

import duckdb
import numpy as np
import pytest

from scrubline.llm import negatives
from scrubline.llm.registry import oracle_sql, queries

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def wanted(rows):
    rows = [(i, v, lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v, _ in rows), default=0)
    m = np.zeros((len(rows), width), np.int64)
    for k, (_, v, _) in enumerate(rows):
        m[k, : len(v)] = [max(-(1 << 24), min(1 << 24, math.floor(256 * float(np.float32(x))))) for x in v]
    label = [(lab + 1) % 10 if i % 7 == 0 else lab for i, _, lab in rows]
    out = []
    for a, (i, *_) in enumerate(rows):
        if i % 50:
            continue
        score = (m @ m[a]).tolist()
        order = sorted((k for k in range(len(rows)) if k != a), key=lambda k: (-score[k], rows[k][0], k))
        for p in [k for k in order if label[k] == label[a]][:5]:
            fit = [k for k in order if label[k] != label[a] and 50 * score[p] <= 100 * score[k] <= 95 * score[p]][:3]
            out += [(i, rows[p][0], r + 1, rows[k][0], score[p], score[k]) for r, k in enumerate(fit)]
    return collections.Counter(out)


def found(spark, rows, path):
    df = spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA + ", row int, score string, anchor int")
    df.repartition(3).write.parquet(path)
    return collections.Counter(tuple(r[n] for n in NAMES) for r in queries()["op13_hard_negatives"](spark, path.removesuffix("/embeddings.parquet")).collect())


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(4)
    centres = r.normal(size=(12, 8))
    near = [(i, (centres[i % 12] + r.normal(size=8) * 0.4).tolist(), i % 12 % 10 if i % 3 else int(r.integers(10))) for i in range(1500)]
    hot = [(2000 + i, [0.5] * 8, i % 3) for i in range(900)]  # one vector, a third of all rows, ties without end
    awkward = [(5000, None, 1), (5050, [0.0] * 8, 2), (5100, [float("nan")] * 8, 3), (5150, [1.0, None] * 4, 4), (5200, [1.0] * 8, None), (5250, [-1.0] * 8, 11),
               (5300, [], 1), (5350, [1.0, 0.5], 2), (None, [1.0] * 8, 1), (5400, [float("inf")] * 8, 1), (5450, [3e38] + [0.0] * 7, 1), (-50, [0.1] * 8, -3)]
    return near + hot + awkward


def test_query(spark, rows, tmp_path):
    got = found(spark, rows, f"{tmp_path}/embeddings.parquet")
    assert got == wanted(rows) and len(got) > 300


def test_repeated_rows_and_sql(spark, rows, tmp_path):
    finite = [r for r in rows if r[1] is None or len(r[1]) == 8 and 3e38 not in r[1]]
    finite += [r for r in finite if r[0] is not None and r[0] % 50 == 0][:6] + finite[:200]
    got = found(spark, finite, f"{tmp_path}/embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    r = duck.execute(oracle_sql()["op13_hard_negatives"])
    names = [d[0] for d in r.description]
    assert got == collections.Counter(tuple(x[names.index(n)] for n in NAMES) for x in r.fetchall())


def test_small_groups(spark, rows, tmp_path, monkeypatch):
    """Groups of a few rows: anchors go on to many, and large clusters are split."""
    for name, n in (("LEAST_GROUP", 60), ("GROUP", 1), ("ANCHORS", 8), ("CHUNK", 16)):
        monkeypatch.setattr(negatives, name, n)
    assert found(spark, rows, f"{tmp_path}/embeddings.parquet") == wanted(rows)


def test_bounds_hold_and_clusters_are_left_out():
    r = np.random.default_rng(1)
    centres = r.normal(size=(40, 16)) * 200
    v = np.floor(np.repeat(centres, 50, 0) + r.normal(size=(2000, 16)) * 20).astype(np.int64)
    cluster = np.repeat(np.arange(40), 50)
    radius = np.array([np.linalg.norm(v[cluster == c] - centres[c], axis=1).max() for c in range(40)])
    index = negatives.Index(centres, radius, np.zeros(40, np.int64), np.ones(40, np.int64))
    q = v[::100]
    lower, upper = index.bounds(q.astype(float))
    exact = q @ v.T
    for c in range(40):
        assert (exact[:, cluster == c] <= upper[:, c, None]).all() and (exact[:, cluster == c] >= lower[:, c, None]).all()
    m = negatives.Members(cluster.copy(), np.arange(2000), np.arange(2000), np.arange(2000) % 2, v.copy())
    seen = []
    original = negatives.scores

    def counted(a, b):
        seen.append(a.shape[0] * b.shape[0])
        return original(a, b)

    negatives.scores = counted
    try:
        w = negatives.Windows.of([[None]] * len(q), [[None]] * len(q), 0, 0)
        best, place = negatives.visit(index, m, q, np.arange(0, 2000, 100), np.zeros(len(q), np.int64), w, True, 5)
    finally:
        negatives.scores = original
    assert sum(seen) < 0.3 * exact.size  # most clusters are never looked at
    for i in range(len(q)):
        fits = [k for k in range(2000) if k % 2 == 0 and k != 100 * i]
        want = sorted(fits, key=lambda k: (-exact[i, k], k))[:5]
        assert m.id[place[i, 0]].tolist() == want


def test_large_components_are_exact():
    a = np.array([[1 << 24] * 40, [-(1 << 24)] * 40])
    assert negatives.scores(a, a).tolist() == [[40 << 48, -(40 << 48)], [-(40 << 48), 40 << 48]]


def test_empty_and_useless_tables(spark, tmp_path):
    for k, rows in enumerate(([], [(50, None, 1)], [(50, [1.0], 1)], [(50, [1.0], 1), (51, [2.0], 1)])):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{k}/embeddings.parquet")
        df = queries()["op13_hard_negatives"](spark, f"{tmp_path}/{k}")
        assert df.columns == NAMES and df.count() == 0
