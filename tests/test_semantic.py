import pytest
from pyspark.sql import functions as F

from stayflow.plans.semantic import Model, Relationship, SemanticError, Table


@pytest.fixture(scope="module")
def model(spark):
    fact = spark.createDataFrame([(1, 10, 5.0, True), (2, 10, 7.0, False), (3, 20, 1.0, True), (4, None, 2.0, True)],
                                 "id long, parent_id long, amount double, ok boolean")
    parent = spark.createDataFrame([(10, "a", 1), (20, "b", 1)], "pid long, name string, grand_id long")
    grand = spark.createDataFrame([(1, "g")], "gid long, label string")
    return Model(
        "m", "f",
        {"f": Table("f", lambda: fact, "id", derived={"double_amount": lambda c: c("amount") * 2}),
         "p": Table("p", lambda: parent, "pid"), "g": Table("g", lambda: grand, "gid")},
        [Relationship("f", "parent_id", "p", "pid"), Relationship("p", "grand_id", "g", "gid")],
        facts={"f.amount": "amount", "f.double_amount": "double_amount"},
        dimensions={"f.id": "id", "f.ok": "ok", "f.parent_id": "parent_id", "p.name": "name", "g.label": "label"},
        metrics={"f.total": lambda c: F.sum(c("amount")), "f.rows": lambda c: F.count(F.lit(1))},
    )


def test_metric_on_parent_table_is_rejected(spark):
    with pytest.raises(SemanticError, match="belong to the measure table"):
        Model("bad", "f", {"f": Table("f", lambda: None, "id"), "p": Table("p", lambda: None, "pid")},
              [Relationship("f", "pid", "p", "pid")], {}, {}, {"p.total": lambda c: F.sum(c("x"))})


def test_fact_and_metric_share_a_namespace():
    with pytest.raises(SemanticError, match="both fact and metric"):
        Model("bad", "f", {"f": Table("f", lambda: None, "id")}, [], {"f.total": "total"}, {},
              {"f.total": lambda c: F.sum(c("total"))})


def test_facts_and_metrics_cannot_mix(model):
    with pytest.raises(SemanticError, match="cannot be combined"):
        model.query(metrics=["total"], facts=["amount"])


def test_facts_and_dimensions_from_one_table(model):
    with pytest.raises(SemanticError, match="one table"):
        model.query(facts=["amount"], dimensions=["p.name"])
    rows = model.query(facts=["amount", "double_amount"], dimensions=["id"]).collect()
    assert sorted((r.id, r.double_amount) for r in rows) == [(1, 10.0), (2, 14.0), (3, 2.0), (4, 4.0)]


def test_unknown_and_ambiguous_names(model, spark):
    with pytest.raises(SemanticError, match="unknown"):
        model.query(metrics=["nope"])
    amb = Model("amb", "f", {"f": Table("f", lambda: None, "id"), "p": Table("p", lambda: None, "pid")},
                [Relationship("f", "pid", "p", "pid")], {}, {"f.name": "name", "p.name": "name"}, {})
    with pytest.raises(SemanticError, match="ambiguous"):
        amb.query(dimensions=["name"])


def test_window_metric_rejected(spark):
    from pyspark.sql import Window
    m = Model("w", "f", {"f": Table("f", lambda: spark.range(3), "id")}, [], {}, {"f.id": "id"},
              {"f.r": lambda c: F.sum(c("id")).over(Window.partitionBy())})
    with pytest.raises(SemanticError, match="window"):
        m.query(metrics=["r"])


def test_global_and_grouped_queries_with_where(model):
    assert model.query(metrics=["total", "rows"]).first().asDict() == {"total": 15.0, "rows": 4}
    g = {r.name: r.total for r in model.query(metrics=["total"], dimensions=["p.name"]).collect()}
    assert g == {"a": 12.0, "b": 1.0}                      # NULL key row drops out
    w = {r.name: r.total for r in model.query(metrics=["total"], dimensions=["p.name"],
                                             where=lambda m: m("f.ok")).collect()}
    assert w == {"a": 5.0, "b": 1.0}                        # where filters before aggregation
    two_hop = model.query(metrics=["rows"], dimensions=["g.label"]).collect()
    assert [(r.label, r.rows) for r in two_hop] == [("g", 3)]


def test_only_referenced_parents_are_joined(model):
    plan = model.query(metrics=["total"], dimensions=["ok"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_validate_detects_duplicate_keys(spark):
    dup = spark.createDataFrame([(1,), (1,)], "id long")
    m = Model("v", "f", {"f": Table("f", lambda: dup, "id")}, [], {}, {"f.id": "id"}, {})
    assert m.validate() == ["v.f: primary key 'id' is not unique"]


def test_denormalised_members_skip_a_complete_join(spark):
    fact = spark.createDataFrame([(1, 10, "x", 5.0), (2, 10, "x", 7.0), (3, 20, "y", 1.0)],
                                 "id long, parent_id long, parent_name long, amount double".replace(
                                     "parent_name long", "parent_name string"))
    parent = spark.createDataFrame([(10, "x", "u"), (20, "y", "v")], "pid long, name string, other string")
    m = Model("d", "f", {"f": Table("f", lambda: fact, "id"), "p": Table("p", lambda: parent, "pid")},
              [Relationship("f", "parent_id", "p", "pid", complete=True)],
              {}, {"p.name": "name", "p.other": "other"}, {"f.total": lambda c: F.sum(c("amount"))},
              denormalized={"p.name": "parent_name"})
    q = m.query(["total"], ["p.name"], where=lambda c: c("p.name") != "zz")
    assert "Join" not in q._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(r) for r in q.collect()) == [("x", 12.0), ("y", 1.0)]
    joined = m.query(["total"], ["p.other"])                      # not denormalised: joins
    assert "Join" in joined._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(SemanticError, match="complete"):
        Model("bad", "f", {"f": Table("f", lambda: fact, "id"), "p": Table("p", lambda: parent, "pid")},
              [Relationship("f", "parent_id", "p", "pid")], {}, {"p.name": "name"}, {},
              denormalized={"p.name": "parent_name"})


def test_parent_attributes_join_after_aggregation(model, spark):
    q = model.query(metrics=["total", "rows"], dimensions=["f.parent_id", "p.name"])
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")          # the join sits above the aggregate
    assert sorted(tuple(r) for r in q.collect()) == [(10, "a", 12.0, 2), (20, "b", 1.0, 1)]   # NULL key dropped
    kept = model.query(metrics=["rows"], dimensions=["f.parent_id", "p.name"], keep_unmatched=True)
    assert sorted((r.parent_id or 0, r.rows) for r in kept.collect()) == [(0, 1), (10, 2), (20, 1)]
    filtered = model.query(metrics=["rows"], dimensions=["f.parent_id", "p.name"], where=lambda c: c("p.name") == "a")
    assert [tuple(r) for r in filtered.collect()] == [(10, "a", 2)]


def test_two_paths_to_a_parent_are_an_error(spark):
    load = lambda *c: lambda: spark.createDataFrame([tuple(range(len(c)))], ", ".join(f"{x} int" for x in c))
    tables = {"sale": Table("sale", load("id", "buyer", "shop"), "id"), "shop": Table("shop", load("id", "town"), "id"),
              "person": Table("person", load("id", "town"), "id"), "town": Table("town", load("id", "name"), "id")}
    one = [Relationship("sale", "buyer", "person", "id"), Relationship("person", "town", "town", "id"), Relationship("sale", "shop", "shop", "id")]
    make = lambda rel: Model("m", "sale", tables, rel, {}, {"town.name": "name", "shop.town": "town"}, {"sale.n": lambda c: F.count(c("id"))})
    assert make(one).query(["sale.n"], ["town.name"]).count() == 0
    both = make([*one, Relationship("shop", "town", "town", "id")])
    with pytest.raises(SemanticError, match="2 ways"):
        both.query(["sale.n"], ["town.name"])
    assert both.query(["sale.n"], ["shop.town"]).count() == 0
