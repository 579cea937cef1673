import numpy as np

from stayflow.llm import epsilon_grid as M


def brute(rows, cosine=0.95):
    ok = [i for i, (v, x) in enumerate(rows) if v is not None and x is not None and len(x) and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    links = {i: set() for i in range(len(rows))}
    for k, i in enumerate(ok):
        for j in ok[:k]:
            x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[i].add(j)
                links[j].add(i)
    label = {i: rows[i][0] for i in range(len(rows))}
    moved = True
    while moved:
        moved = False
        for i, near in links.items():
            for j in near:
                if label[j] < label[i]:
                    label[i], moved = label[j], True
    return sorted(((rows[i][0], len(links[i]), label[i], rows[i][0] is None or label[i] == rows[i][0]) for i in range(len(rows))), key=str)


def run(spark, rows, kind="float"):
    df = spark.createDataFrame([(v, x, 3, "c") for v, x in rows], f"vec_id long, embedding array<{kind}>, label int, key string")
    return sorted((tuple(r) for r in M.near_duplicates(df).collect()), key=str)


def test_edge_cases(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]),
            (9, [2.0, 0.0]), (10, [1.0]), (11, [5.0]), (12, [-1.0, 0.0]), (None, [1.0, 0.0]), (13, [1e-30, 0.0]), (14, [1.0, 0.25]), (15, [-0.0, 1.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, "double") == brute(rows)
    assert run(spark, []) == []


def test_clusters_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16)
    monkeypatch.setattr(M, "LEAF", 4)
    rng = np.random.default_rng(4)
    rows = []
    for c in range(6):
        centre = rng.normal(size=12)
        rows += [centre + rng.normal(size=12) * s for s in rng.choice([0.0, 0.05, 0.2, 0.35], 50)]
    ids = rng.permutation(len(rows)).tolist()
    rows = [(i, [float(np.float32(c)) for c in x]) for i, x in zip(ids, rows)]
    assert run(spark, rows) == brute(rows)
