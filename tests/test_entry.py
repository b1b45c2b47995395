import __spark_entry__ as E


def test_contract_keys_match():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


def test_library_stands_without_the_training_data_operators(monkeypatch):
    import importlib.util
    import sys

    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec",
                        lambda name, *a: None if name.startswith("lakemart.llm") else find(name, *a))
    assert set(E.queries()) == set(E.QUERIES) and set(E.oracle_sql()) == set(E.SQL)
    # nothing outside the subpackage imports it
    used = [m for m in sys.modules.values() if getattr(m, "__name__", "").startswith("lakemart.")
            and not m.__name__.startswith("lakemart.llm")]
    assert not any("lakemart.llm" in str(getattr(v, "__module__", "") or "")
                   for m in used for v in vars(m).values())


def test_library_stands_where_a_library_of_those_operators_is_missing(monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "lakemart.llm.queries", None)  # its import fails
    assert set(E.queries()) == set(E.QUERIES) and set(E.oracle_sql()) == set(E.SQL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["sales_key", "customer_key", "seller_key", "product_key", "date_key"]
