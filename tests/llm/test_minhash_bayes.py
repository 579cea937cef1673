import random
import re
from collections import defaultdict

import pytest

from stayflow.llm import minhash_bayes as M


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(rows, percent=85):
    sets = []
    for d, t in rows:
        w = words(t)
        sets.append((d, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())))
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(((d, len(s), root(d) if d is not None else None, d is None or root(d) == d) for d, s in sets), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def near(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def test_edge_cases(make_docs):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"), (7, "a b c d e f g"),
            (8, "A B C D E F G"), (8, "A B C D E F G"), (None, "a b c d e f g"), (9, "É a b c d"), (10, "é a b c d"), (11, "w " * 30000)]
    assert got(M.near_duplicates(make_docs(rows, extra=True))) == brute(rows)


def test_rows_that_share_an_id_are_one_document(make_docs):
    rows = [(1, "a b c d e f g"), (2, "h i j k l m n"), (2, "a b c d e f g"), (3, "h i j k l m n")]
    assert {r.component_id for r in M.near_duplicates(make_docs(rows)).collect()} == {1}


def test_empty_table(make_docs):
    out = M.near_duplicates(make_docs([]))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.count() == 0


def test_groups_and_chains_match_brute_force(make_docs, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_SETS", 8)
    rng = random.Random(3)
    rows, ids = [], list(range(400))
    rng.shuffle(ids)
    for _ in range(4):
        base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        for _ in range(45):  # variants of which many are linked only through others
            rows.append((ids.pop(), near(rng, base, rng.choice([0, 1, 2, 2, 3]))))
    chain = [f"c{i}" for i in range(400)]
    for i in range(0, 120, 6):
        rows.append((ids.pop(), " ".join(chain[i : i + 200])))
    for _ in range(60):
        rows.append((ids.pop(), " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60)))))
    assert got(M.near_duplicates(make_docs(rows))) == brute(rows)


def test_only_members_of_one_bucket_are_compared(make_docs, monkeypatch):
    rng, rows, seen, made = random.Random(17), [], [], []
    base = [f"w{i}" for i in range(200)]
    for d in range(120):  # one template, similarity of about 0.65, no links: buckets chain, but few members share one
        rows.append((d, near(rng, base, 4)))
    rows += [(200, near(rng, base, 0)), (201, near(rng, base, 1))]
    confirmed, components = M._store.land, M._store.components
    monkeypatch.setattr(M._store, "land", lambda df, name: seen.append((name, out := confirmed(df, name))) or out)
    monkeypatch.setattr(M._store, "components", lambda links: made.append(links) or components(links))
    assert got(M.near_duplicates(make_docs(rows))) == brute(rows)
    full = [df for name, df in seen if name == "full"][0]
    assert len(made) == 2 and "key" in full.columns and "shingles" not in full.columns  # links only, never the closure of buckets
    left = [df for name, df in seen if name == "meeting"][0]
    shared = {}
    for r in [df for name, df in seen if name == "open"][0].collect():
        shared.setdefault(r.key, set()).add(r.v)
    assert all(r.v in shared[r.key] for r in left.collect())
    assert max(map(len, shared.values())) < len(rows)


def test_deduplicate_keeps_one_row_of_each_group(make_docs):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (None, "a b c d e f g"), (5, "z")]
    out = M.deduplicate(make_docs(rows, extra=True))
    assert sorted((str(r.doc_id) for r in out.collect())) == ["1", "2", "5", "None"]
    assert "ref" in out.columns


def test_pruning_bound_is_monotone_and_lets_the_threshold_pass():
    least = M.least_matches(0.85)
    assert least == sorted(least) and least[0] == 0 and least[-1] < 0.85 * M.HASHES


def test_bands_reach_every_threshold():
    assert M.bands_for(85) == (20, 6) and M.bands_for(80) == (24, 5) and M.bands_for(100) == (1, M.HASHES)
    for percent in range(8, 100):
        bands, rows = M.bands_for(percent)
        assert bands * rows <= M.HASHES and (1 - (percent / 100) ** rows) ** bands <= M.BAND_MISS
    with pytest.raises(ValueError):
        M.bands_for(5)


def test_pairs_at_a_low_threshold_are_linked(make_docs):
    rng, rows = random.Random(11), []
    for k in range(60):  # nine words take 45 of 196 shingles: (196 - 45) / (196 + 45) = 0.627
        base = [f"w{k}_{i}" for i in range(200)]
        edited = [f"x{k}_{i}" if i % 20 == 7 and i < 180 else w for i, w in enumerate(base)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(edited))]
    rng.shuffle(rows)
    assert got(M.near_duplicates(make_docs(rows), 60)) == brute(rows, 60)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(M.op1_minhash_near_dedup(spark, sf)) == brute(rows)
