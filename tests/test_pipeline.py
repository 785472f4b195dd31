import pytest

from rillmark.operators import checks
from rillmark.plans.pipeline import Pipeline, Stage


def test_order_retries_and_publication_guard():
    seen, tries = [], []

    def flaky(_):
        tries.append(1)
        if len(tries) < 3:
            raise RuntimeError("again")
        return "ok"

    p = Pipeline([Stage("c", lambda x: seen.append("c"), ("b",), publishes=True), Stage("b", flaky, ("a",), retries=2), Stage("a", lambda x: seen.append("a"))])
    assert [s.name for s in p.order()] == ["a", "b", "c"]
    assert p.run()["b"] == "ok" and seen == ["a"]
    p.run(publish=True)
    assert seen == ["a", "a", "c"]
    with pytest.raises(ValueError):
        Pipeline([Stage("a", print, ("b",)), Stage("b", print, ("a",))]).order()
    with pytest.raises(ValueError):
        Pipeline([Stage("a", print, ("x",))]).order()
    with pytest.raises(RuntimeError):
        Pipeline([Stage("a", lambda x: (_ for _ in ()).throw(RuntimeError("no")))]).run()


def test_frozen_inputs():
    checks.frozen_inputs({"a": "1", "b": "2"}, {"a": "1"})
    with pytest.raises(ValueError):
        checks.frozen_inputs({"a": "1"}, {"a": "2"})


def test_checks(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "k string, v string")
    got = {r.check_name: r.violations for r in checks.union([checks.not_null(df, ["k", "v"]), checks.unique(df, ["k"]), checks.accepted(df, "v", ["x", "y"]), checks.relationship(df, "k", spark.createDataFrame([("b",)], "k string"), "k")]).collect()}
    assert got == {"not_null:k": 1, "not_null:v": 0, "unique:k": 1, "accepted:v": 1, "relationship:k": 2}
