"""Near-duplicate vectors against brute force."""

import numpy as np

from faultline.llm import queries, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow_links(rows, least=0.93):
    """Rows as (links, smallest id reachable), by all pairs of a label."""
    units = []
    for _, v, label in rows:
        good = v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        x = np.array(v, np.float32).astype(float) if good else None
        units.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if good else None)
    links, groups = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while groups[i] != i:
            i = groups[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                groups[max(a, b)] = min(a, b)
    least_id = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least_id[find(i)] = min(d, least_id.get(find(i), d))
    return sorted(((d, links[i], least_id.get(find(i))) for i, (d, *_) in enumerate(rows)), key=repr)


def cloud(draw, n, width=64, centres=20, spread=0.02):
    """Some vectors alone, some around common points."""
    points = draw.normal(size=(centres, width))
    points /= np.linalg.norm(points, axis=1)[:, None]
    out = []
    for i in range(n):
        if i % 3 == 0:
            v = draw.normal(size=width)
        else:
            v = points[draw.integers(centres)] + draw.normal(size=width) * spread * draw.integers(1, 4)
        out.append([float(x) for x in (v / np.linalg.norm(v) * (1 + i % 5)).astype(np.float32)])
    return out


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=repr)


def test_links_and_components(spark):
    draw = np.random.default_rng(5)
    rows = [(i, v, int(draw.integers(3))) for i, v in enumerate(cloud(draw, 900))]
    rows += [(2000 + i, rows[i % 7][1], rows[i % 7][2]) for i in range(60)]  # equal vectors
    rows += [(3000, rows[1][1], None), (3001, None, 1), (3002, [], 1), (3003, [0.0] * 64, 1), (3004, [float("nan")] + [1.0] * 63, 1),
             (3005, [None] + [1.0] * 63, 1), (3006, [float("inf")] + [1.0] * 63, 1), (None, rows[2][1], rows[2][2]), (None, rows[2][1], 77),
             (3007, [1.0, 2.0], 1), (3008, [1.0, 2.001], 1), (3009, [2e-38, 4e-38], 1), (3010, [1e38] * 65, 1), (3010, [1e38] * 65, 1), (1, rows[1][1], rows[1][2])]
    assert got(vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == slow_links(rows)


def test_a_dense_list_in_blocks(spark):
    """One group of near copies larger than a block; blocks don't change the result, nor does a margin that is always enough."""
    draw = np.random.default_rng(6)
    rows = [(i, v, 1) for i, v in enumerate(cloud(draw, 500, width=16, centres=1, spread=0.05))]
    table, want = spark.createDataFrame(rows, SCHEMA), slow_links(rows)
    assert got(vectors.near_duplicates(table, block=60, margin=0.1871)) == want
    assert got(vectors.near_duplicates(table, margin=0.1871)) == want


def test_recall(spark):
    """Pairs just within the limit, in random directions, are nearly all found."""
    draw = np.random.default_rng(7)
    rows = []
    for i in range(1500):
        v = draw.normal(size=64)
        v /= np.linalg.norm(v)
        d = draw.normal(size=64)
        d -= d @ v * v
        d /= np.linalg.norm(d)
        c = draw.uniform(0.9305, 0.95)
        rows += [(2 * i, [float(x) for x in v], i % 2), (2 * i + 1, [float(x) for x in c * v + np.sqrt(1 - c * c) * d], i % 2)]
    found = {r.vec_id: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    hits = sum(found[2 * i + 1].component_id == 2 * i for i in range(1500))
    assert hits >= 0.99 * 1500, hits
    assert all(r.n_links <= 1 for r in found.values())


def test_codes_bound_distances():
    draw = np.random.default_rng(8)
    units = [u.tobytes() for u in map(vectors.unit, np.array(cloud(draw, 600)))]
    model = vectors.Quantiser.load(vectors.Quantiser.fit(units, 12, 0.1).dump())
    rows = vectors._padded(units, 64)
    residuals = rows - model.centres[3]
    code, left = model.codes(residuals)
    true = np.linalg.norm(rows[:, None] - rows[None], axis=2)
    assert (np.abs(model.distances(residuals, code) - left[None, :]) <= true + 1e-6).all()


def test_empty_and_clashing(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, [1.0, 0.0], 1, "n", 2, 3), (2, [1.0, 0.01], 1, "n", 2, 3), (3, [0.0, 1.0], 1, "n", 2, 3)]
    table = spark.createDataFrame(rows, SCHEMA + ", node string, n int, cell int")
    assert got(vectors.near_duplicates(table)) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(queries.op12_vectors(spark, "/root/testdata/sf0.001")) == slow_links(rows)
