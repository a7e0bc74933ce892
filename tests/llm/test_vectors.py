"""Vector operators against brute force on small tables with nulls, odd lengths, ties and repeated rows."""
import hashlib
import math

import numpy as np
import pytest

from txnscope.llm import bisectors, nn_descent, whitening
from txnscope.llm.queries import queries
from tests.conftest import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<float>, key int, vec string, component int, cluster int, n int, distance int"
NAN, INF = float("nan"), float("inf")


def vectors(seed, n, dims):
    r = np.random.default_rng(seed)
    return np.round(r.normal(0, 0.4, (n, dims)) @ np.diag(np.linspace(0.2, 2, dims)), 3).astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v],
                                   1, "x", 2, 3, 4, 5) for i, v in rows], SCHEMA).repartition(3)


def odd_rows(dims):
    """Rows that take no part."""
    return [(900, None), (901, [NAN] + [0.0] * (dims - 1)), (902, [INF] + [0.0] * (dims - 1)), (903, []),
            (904, [None] + [1.0] * (dims - 1)), (905, [1.0] * (dims + 1))]


# --- 11 whitening
def test_plane_products_are_exact():
    r = np.random.default_rng(3)
    for rows, dims, top in ((1, 3, 2), (63, 4, 300), (200, 5, 2 ** 20), (130, 3, 2 ** 62)):
        y = r.integers(0, top, (rows, dims)).astype(np.uint64)
        products, sums = whitening.plane_products(y)
        o = y.astype(object)
        assert (products == o.T @ o).all() and (sums == o.sum(axis=0)).all()


def test_block_sums_with_negative_numbers():
    x = np.random.default_rng(4).integers(-2 ** 40, 2 ** 40, (77, 3))
    got = {(i, j): v for i, j, v in whitening.block_sums(x)}
    o = x.astype(object)
    for i in range(3):
        assert got[i, -1] == o[:, i].sum()
        for j in range(i, 3):
            assert got[i, j] == (o[:, i] * o[:, j]).sum()
    assert got[-1, -1] == 77


def test_whitening_against_covariance(spark):
    v = vectors(1, 150, 8)
    rows = [(i, x) for i, x in enumerate(v)] + [(7, v[7]), (None, v[9])]
    got = whitening.whiten(frame(spark, rows + odd_rows(8)), k=5).toPandas()
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in r] for _, r in rows])
    n, s = len(x), x.sum(axis=0)
    gap = x - s / n
    cov = gap.T @ gap / n
    values = np.linalg.eigvalsh(cov)[::-1]
    assert len(got) == n * 5 and set(got.n) == {n} and sorted(set(got.component)) == [1, 2, 3, 4, 5]
    assert got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1
    assert np.allclose(got.groupby("component").explained.first(), values[:5] / np.trace(cov), rtol=1e-9)
    exact = ((n * x.astype(object) - s.astype(object)) ** 2).sum(axis=1)
    want = {i: e for (i, _), e in zip(rows, exact)}
    assert all(d == want[None if np.isnan(i) else int(i)] for i, d in zip(got.vec_id, got.deviation))
    for c, part in got.groupby("component"):
        z = part.set_index("vec_id").whitened
        direction = np.linalg.lstsq(gap, np.array([z.loc[i].iloc[0] if i == 7 else z[i] if i is not None else z.loc[np.nan]
                                                   for i, _ in rows]).astype(float), rcond=None)[0]
        assert np.allclose(cov @ direction, values[c - 1] * direction, atol=1e-7)


def test_whitening_without_variance_large_numbers_and_empty(spark):
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.whitened, r.explained, r.identity_error, r.deviation) for r in one] \
        == [(1, None, None, None, 0), (2, None, None, None, 0)]
    flat = whitening.whiten(frame(spark, [(i, [float(i), 1.0]) for i in range(4)])).collect()
    assert {r.component: r.whitened is None for r in flat} == {1: False, 2: True}
    huge = whitening.whiten(frame(spark, [(i, [s * 1e30, float(i)]) for i, s in enumerate((1, -1, 1, 1))])).collect()
    assert all(r.deviation is None for r in huge) and len(huge) == 8
    none = whitening.whiten(frame(spark, odd_rows(8)[:4]))
    assert none.count() == 0 and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                                                  "identity_error"]


# --- 13 bisector tournament
def brute_clusters(rows, k, rounds):
    x = [[math.floor(64 * float(np.float32(c))) for c in v] for _, v in rows]
    order = sorted(range(len(rows)), key=lambda i: (hashlib.sha256(
        f"1:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), x[i]))
    cents = [x[i] for i in order[:k]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))                                # noqa: E731
    for at in range(rounds + 1):
        best = [min(range(len(cents)), key=lambda c: (far(v, cents[c]), c)) for v in x]
        if at < rounds:
            for c in range(len(cents)):
                own = [v for v, b in zip(x, best) if b == c]
                if own:
                    cents[c] = [sum(col) // len(own) for col in zip(*own)]
    dist = [far(v, cents[b]) for v, b in zip(x, best)]
    return sorted((-1 if i is None else i, b, d, sum(e for e, o in zip(dist, best) if o == b), sum(dist),
                   hashlib.sha256(",".join(map(str, cents[b])).encode()).hexdigest())
                  for (i, _), b, d in zip(rows, best, dist))


def got_clusters(df):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia,
                   r.centroid_sha256) for r in df.collect())


@pytest.mark.parametrize("k, n, grain", [(5, 80, 3), (4, 40, 0), (16, 9, 3)])
def test_clusters_against_all_distances(spark, k, n, grain):
    v = np.round(vectors(2, n, 6), grain)                      # grain 0: few points, many ties
    rows = [(i, x) for i, x in enumerate(v)] + [(3, v[3]), (None, v[5])]
    got = got_clusters(bisectors.cluster(frame(spark, rows + odd_rows(6)), dims=6, k=k, rounds=3))
    assert got == brute_clusters(rows, k, 3)


def test_large_components_stay_exact(spark):
    r = np.random.default_rng(8)
    rows = [(i, [float(np.float32(c)) for c in r.normal(0, 3e6, 3)]) for i in range(30)]
    assert got_clusters(bisectors.cluster(frame(spark, rows), dims=3, k=4)) == brute_clusters(rows, 4, 3)
    far = bisectors.cluster(frame(spark, [(i, [c, 0.0]) for i, c in enumerate((1e30, -1e30, 0.0))]), dims=2, k=1, rounds=1)
    assert far.count() == 3 and any(r.distance is None for r in far.collect())


def test_a_tie_goes_to_the_smaller_number():
    cents = np.array([[0, 0], [2, 0], [0, 2], [2, 2]])
    assert bisectors.winners(np.array([[1, 1], [1, 0], [2, 1], [1, 2], [2, 2]]), cents).tolist() == [0, 0, 1, 2, 3]


def test_no_vectors_no_clusters(spark):
    out = bisectors.cluster(frame(spark, odd_rows(64)))
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                                "centroid_sha256"]


def test_registered_queries_on_the_given_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    rows = list(zip(table.vec_id, table.embedding))
    assert got_clusters(queries()["op13_centroid_clusters"](spark, SF_SMALL)) == brute_clusters(rows, 16, 3)
    white = queries()["op11_embedding_whitening"](spark, SF_SMALL).toPandas()
    assert len(white) == 32 * len(rows) and white.identity_error.max() < 1e-9
    z = white.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.cov(z.T, bias=True) - np.eye(32)).max() < 1e-9


# --- 12 nearest neighbours
def brute_nearest(rows, every=20, k=20):
    """{query: [(vec_id, score)]} over (id, vector) rows; an id counts with its best vector."""
    out = {}
    for i, v in rows:
        if i % every:
            continue
        score = {}
        for j, w in rows:
            if j != i:
                score[j] = max(score.get(j, -math.inf), float(np.dot(np.float64(v), np.float64(w))))
        out[i] = sorted(score.items(), key=lambda z: (-z[1], z[0]))[:k]
    return out


def got_nearest(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    hits = [len({j for j, _ in got.get(i, [])} & {j for j, _ in w}) for i, w in want.items()]
    return sum(hits) / sum(len(w) for w in want.values())


def test_nearest_small_tables_are_exact(spark):
    v = vectors(5, 120, 6)
    v[3] *= 10
    rows = [(i, x) for i, x in enumerate(v)] + [(500 + i, v[3]) for i in range(40)] + [(40, v[40])]
    odd = odd_rows(6) + [(906, [0.0] * 6), (None, v[1])]
    want = brute_nearest([r for r in rows if r[0] != 40] + [(40, v[40])])
    got = got_nearest(nn_descent.nearest(frame(spark, rows + odd)))
    assert recall(got, want) >= 0.99 and {i: len(x) for i, x in got.items()} == {i: 20 for i in want}
    # Copies: the smallest ids come first among equal scores.
    copies = [j for j, _ in got[500] if j == 3 or j >= 500]
    assert len(copies) == 20 and copies == [3, *range(501, 540)][:len(copies)]
    for i, found in got.items():
        scores = {j: s for j, s in brute_nearest([r for r in rows if r[0] % 20 or r[0] == i], k=10 ** 6)[i]} | dict(want[i])
        assert found == sorted(found, key=lambda z: (-z[1], z[0]))
        assert all(abs(s - scores[j]) < 1e-12 for j, s in found if j in scores)


def test_nearest_few_none_and_single(spark):
    assert nn_descent.nearest(frame(spark, odd_rows(4)[:5])).count() == 0
    assert nn_descent.nearest(frame(spark, [(20, [1.0, 2.0])])).count() == 0
    pair = got_nearest(nn_descent.nearest(frame(spark, [(20, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [-1.0, 0.0])])))
    assert pair == {20: [(1, 5.0), (2, -1.0)]}


def test_recall_over_several_parts_with_a_third_near_copies(spark, monkeypatch):
    r = np.random.default_rng(6)
    v = r.normal(0, 1, (1800, 24))
    v[:600] = v[0] + r.normal(0, 0.01, (600, 24))
    v *= r.uniform(0.5, 2, (1800, 1))
    rows = [(i, x.astype(np.float32)) for i, x in enumerate(v)]
    monkeypatch.setattr(nn_descent, "PART", 300)
    assert recall(got_nearest(nn_descent.nearest(frame(spark, rows))), brute_nearest(rows)) >= 0.95


def test_queries_that_are_not_indexed(spark):
    v = vectors(7, 400, 8)
    index = nn_descent.build(frame(spark, [(i, x) for i, x in enumerate(v)]))
    asked = vectors(17, 30, 8)
    queries_df = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in enumerate(asked)], "query_id bigint, vec array<double>")
    got = got_nearest(nn_descent.search(index, queries_df, k=5))
    hit = sum(len({j for j, _ in got[i]} & set(np.lexsort((np.arange(400), -(np.float64(v) @ np.float64(x))))[:5].tolist()) - {i})
              for i, x in enumerate(asked))
    assert hit >= 0.9 * 5 * 30 - 30


def test_registered_search_on_the_given_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    want = brute_nearest(list(zip(table.vec_id, table.embedding)))
    got = got_nearest(queries()["op12_nearest_neighbours"](spark, SF_SMALL))
    assert set(got) == set(want) and recall(got, want) >= 0.9


def test_rows_of_the_graph_and_search_follow_the_parts_not_the_nodes(spark, monkeypatch):
    rows, store = {}, nn_descent.Tables.store

    def counted(tables, df, name):
        kept = store(tables, df, name)
        rows.setdefault(name, []).append(kept.count())
        return kept
    monkeypatch.setattr(nn_descent.Tables, "store", counted)
    frames = type(spark.range(0))                           # however many partitions number the nodes
    monkeypatch.setattr(frames, "repartitionByRange", lambda df, n, *c, f=frames.repartitionByRange: f(df, max(n, 60), *c))
    data = [(i, x) for i, x in enumerate(vectors(8, 2400, 8))]
    got = got_nearest(nn_descent.nearest(frame(spark, data)))
    assert recall(got, brute_nearest(data)) >= 0.99
    parts = 16
    made = {n: max(c) for n, c in rows.items() if n not in ("ann-classes", "ann-nodes", "ann-queries")}
    assert made and max(made.values()) <= parts * (parts + 4) < 2400 / 4


def test_largest_of_each_row():
    s = np.random.default_rng(9).normal(0, 1, (50, 3001)).astype(np.float32)
    s[3, 5:400] = 2.5                                       # equal numbers
    for k, wide in ((7, s), (7, s[:, :60]), (60, s[:, :60])):
        row, col = nn_descent.nearest_in_rows(wide, k)
        assert np.array_equal(np.bincount(row), np.full(50, k)) and len(set(zip(row.tolist(), col.tolist()))) == 50 * k
        assert np.array_equal(np.sort(wide[row, col].reshape(50, k)), np.sort(wide)[:, -k:])
