import random

import pytest

import corpus_pipeline as P
from stayflow.llm import _store, registry

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(seed, n=150):
    rng = random.Random(seed)
    return " ".join(rng.choice(["river", "stone", "walk", "and", "the", "light", "over", "of", "house", "window"]) + rng.choice(["", "s", "ed"]) for _ in range(n))


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_in_order_and_columns(spark, make_docs):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "repeated_strings", "packing"]
    docs = make_docs([(1, good(1)), (2, None), (3, ""), (None, good(2)), (4, good(3)), (4, good(3)), (5, "#### " * 200)], extra=True)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.schema.simpleString() == docs.schema.simpleString()
        out.collect()
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_quality_stages_drop_junk_and_keep_clean_documents(spark, make_docs):
    clean = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    docs = clean.select(*COLUMNS).unionByName(make_docs([(10**6 + i, t) for i, t in enumerate(["few words", None, "#$% " * 100, "same words again here now " * 60])]))
    kept = rows(P.quality_classifier(spark, P.quality_rules(spark, docs, SF), SF))
    assert not any(d >= 10**6 for d in kept) and len(kept) > 0.9 * clean.count()


def test_one_document_of_each_group_stays_and_repeats_go(spark, make_docs):
    base = good(7, 400)
    near = base.replace("river", "brook", 1)
    docs = make_docs([(9, base), (3, near), (5, base), (7, good(8)), (8, None), (11, good(9) + " | " + base[:900])])
    kept = P.near_duplicates(spark, docs, SF)
    assert sorted(rows(kept)) == [3, 7, 8, 11]
    cut = rows(P.repeated_strings(spark, kept, SF))
    assert base[300:600] not in cut[3].text and cut[7].text == good(8) and cut[8].text is None
    assert all(r.n_chars == len(r.text) for r in cut.values() if r.text is not None)


def test_near_duplicates_have_a_similarity_of_0_8_or_more(spark, make_docs):
    base = [f"w{i}" for i in range(400)]
    near = {k: " ".join(f"x{k}_{i}" if i % 40 == 7 and i < 40 * k else w for i, w in enumerate(base)) for k in (8, 10)}
    # a changed word takes 5 of 396 shingles: 356 / 436 = 0.817 is a near-duplicate, 346 / 446 = 0.776 is none
    assert sorted(rows(P.near_duplicates(spark, make_docs([(1, " ".join(base)), (2, near[8])]), SF))) == [1]
    assert sorted(rows(P.near_duplicates(spark, make_docs([(1, " ".join(base)), (2, near[10])]), SF))) == [1, 2]


@pytest.mark.parametrize("sf", [SF])
def test_run_equals_its_stages(spark, sf):
    out = P.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES:
        docs = _store.land(stage(spark, docs, sf), name)
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert P.ORACLE_SQL is None and out.columns[:3] == ["doc_id", "start", "length"]


def test_registry_names_one_query_per_operator():
    assert [int(n[2:].split("_")[0]) for n in registry.SPARK] == list(range(1, 14))
    assert set(registry.ORACLE) <= set(registry.SPARK)
