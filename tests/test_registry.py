"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from loadloom.registry.oracles import ORACLES
from loadloom.registry.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    from conftest import SF

    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {
        "preview_rows", "bootstrap_sample", "gbt_metrics", "forest_metrics", "forest_importance",
        "variant_comparison", "model_comparison", "ab_scored_rows", "batch_scored_keys",
    }


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    assert compare(QUERIES[name](spark, sf), ORACLES[name], duck) is None


def test_appending_by_key_reads_and_moves_its_line_items_once(spark, sf, no_broadcast, monkeypatch):
    from conftest import counting_reads

    from loadloom.registry import queries

    line = queries.table(spark, sf, "lineitem")
    counted, seen = counting_reads(line)
    monkeypatch.setattr(queries, "table", lambda *_: counted)
    stored = QUERIES["appended_by_key"](spark, sf)
    # Counted by key, looked at for hot keys, divided; whatever is done to the rows later reads what was stored.
    assert seen.value <= 3 * line.count()
    assert stored.count() == line.count()


def test_entry_gives_both_parts(spark):
    rows = {r["split"]: r["rows"] for r in entry.entry(spark).collect()}
    assert set(rows) == {"train", "test"} and rows["train"] == 4 * rows["test"]


def test_no_query_plans_a_cross_join_or_python_rows(spark, sf):
    from conftest import plan_of

    for name in ("prep_apply", "training_set", "feature_lookup", "champion_challenger", "changed_rows",
                 "refresh_train", "metrics_per_target", "ab_routed_prediction", "temporal_split_rows"):
        plan = plan_of(QUERIES[name](spark, sf))
        for bad in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)
