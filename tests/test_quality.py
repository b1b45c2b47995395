from lakemart.operators import quality
from lakemart.operators.quality import Check


def test_each_test_fails_on_one_bad_row(spark):
    child = spark.createDataFrame([(1, "a", 5, "x"), (2, "b", 6, "y"), (2, None, 99, "bad"),
                                   (3, "c", None, "x")], "id int, name string, score int, kind string")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert quality.not_null(child, "name").count() == 1
    assert quality.unique(child, "id").count() == 1
    assert quality.accepted_values(child, "kind", ["x", "y"]).count() == 1
    assert quality.accepted_range(child, "score", 1, 10).count() == 1
    assert quality.relationships(child, "id", parent, "id").count() == 1
    assert quality.unique_combination(child, ["id", "kind"]).count() == 0
    dup = child.unionByName(child.limit(1))
    assert quality.unique_combination(dup, ["id", "kind"]).count() == 1
    checks = [Check("t", "not_null", "name"), Check("t", "unique", "id"),
              Check("t", "accepted_values", "kind", values=("x", "y")),
              Check("t", "accepted_range", "score", min_value=1, max_value=10),
              Check("t", "relationships", "id", to="p", field="id"),
              Check("t", "unique_combination", "", columns=("id", "kind")),
              Check("p", "unique", "id")]
    summary = {(r.model, r.test, r.column_name): r.violations
               for r in quality.run_tests({"t": child, "p": parent}, checks).collect()}
    assert summary == {("t", "not_null", "name"): 1, ("t", "unique", "id"): 1,
                       ("t", "accepted_values", "kind"): 1, ("t", "accepted_range", "score"): 1,
                       ("t", "relationships", "id"): 1, ("t", "unique_combination", "id,kind"): 0,
                       ("p", "unique", "id"): 0}
