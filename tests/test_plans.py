"""What the plans must and must not hold."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name: str) -> str:
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["v12_yearly", "v13_counterparty_year", "v22_budget_month", "v28_payment_combined", "cl06_payee_class", "ag17_counterparties",
                                  "pv02_name_leaks", "rg02_payment_rows", "fn11_words_to_cents", "ex05_refused_statements", "dq02_retyped_posting"])
def test_no_python_and_no_nested_loops(spark, name):
    p = plan(spark, name)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_rankings_are_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(spark, "v13_counterparty_year")
    assert "TakeOrderedAndProject" in plan(spark, "tk02_global_top_k")


def test_interval_check_is_one_equi_join(spark):
    p = plan(spark, "jn08_interval_anti_join")
    assert "LeftOuter" in p and "BroadcastNestedLoopJoin" not in p


def test_columns_are_pruned(spark):
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", entry.queries()["v14_type_year"](spark, FOLDER)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    assert scans and not any("o_totalprice" in s for s in scans)


@pytest.mark.parametrize("name", ["ag17_counterparties", "pv06_person_free_ranking", "rp10_natural_persons"])
def test_lines_are_classified_once_for_the_registry(spark, name):
    p = plan(spark, name)
    assert "lineitem.parquet" not in p and "l_orderkey" not in p


@pytest.mark.parametrize("name", ["ex01_statement_lines", "ex05_refused_statements", "ex18_readers_by_kind"])
def test_texts_are_read_once(spark, name):
    """The documents are written from orders and customers: one scan of each."""
    scans = re.findall(r"FileScan parquet .*?/(\w+)\.parquet", plan(spark, name))
    assert sorted(scans) == ["customer", "orders"]


@pytest.mark.parametrize("name,most", [("v17_kae_reconciliation", 15), ("v22_budget_month", 15), ("v24_grant_to_date", 15), ("dq04_mark_paid_through", 20), ("rg05_route_by_type", 4)])
def test_shared_relations_are_read_not_derived_again(spark, name, most):
    assert plan(spark, name).count("FileScan") <= most


def test_no_python_outside_the_training_text(spark):
    for name in ("dq04_greedy_pairing", "dq04_mark_paid_through"):
        assert "Pandas" not in plan(spark, name) and "Python" not in plan(spark, name)


def test_texts_of_a_decision_are_derived_once(spark):
    """every way of reading an allocation decision takes the written texts, tables and finds."""
    assert plan(spark, "ex15_read_decision").count("orders.parquet") == 0


def test_tables_of_two_purposes_are_derived_once(spark):
    """our lines, the tables and the texts are read from what was written."""
    assert plan(spark, "ex14_split_two_purpose").count("orders.parquet") == 0


def test_section_tables_are_read_in_one_pass(spark):
    """rows meet their section's total beside each other, not by joins of the lines with themselves."""
    assert plan(spark, "ex16_section_tables").count("orders.parquet") == 1


def test_a_releases_tables_share_what_they_are_made_of(spark):
    """acts, items with their acts and payments are written once; the other tables are read from them."""
    from obolus.plans.bindings import Bound
    from obolus.sources.landing import stored_release
    release = stored_release(Bound(spark, FOLDER).stored().release, ["budget_line"])
    for name in ("act", "payment", "commitment", "award", "budget_line", "procurement", "procurement_party", "acceptance", "counterparty"):
        p = getattr(release, name)._jdf.queryExecution().executedPlan().toString()
        assert "orders.parquet" not in p and "lineitem.parquet" not in p and "supplier.parquet" not in p, name


@pytest.mark.parametrize("name", ["src13_register_release", "src14_build_manifest"])
def test_a_release_is_counted_from_stored_tables(spark, name):
    assert not re.search(r"(orders|lineitem)\.parquet", plan(spark, name))


def test_name_leaks_are_found_from_what_was_written(spark):
    """the tokens of all lines do not take part in the last joins, only the finds and the covered places."""
    assert plan(spark, "pv02_name_leaks").count("FileScan") <= 3


def test_a_lines_code_is_read_once(spark):
    """F14, F16: the scheme and the major of a code are taken once, not by every rule that asks for them."""
    from obolus import fixed_values as fv
    assert plan(spark, "cl06_payee_class").count(fv.CODE_NEW) <= 3


def test_items_meet_their_acts_last_and_by_the_orders_key(spark):
    """F5, F6, F7, F8: no line is dealt out again with its act's columns, neither by the act's printed key nor by part or supplier."""
    from obolus.plans.bindings import Bound
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = Bound(spark, FOLDER).raw_payment._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert re.search(r"Join \[(\w+)#", p).group(1) == "l_orderkey" and "hashpartitioning(ada#" not in p


def test_transfer_tables_are_read_in_one_pass(spark):
    """lines are derived and dealt out once; sections, sums and candidates are windows over them."""
    p = plan(spark, "ex25_transfer_rows")
    assert p.count("orders.parquet") == 1 and p.count("hashpartitioning(doc_id") == 1


def test_letterheads_are_read_once(spark):
    """the poster's own name and the other bodies' meet the letterheads in one table."""
    assert plan(spark, "jn18_letterheads").count("orders.parquet") == 0
    assert plan(spark, "ex06_budget_lines").count("orders.parquet") == 2


def test_a_statements_row_is_searched_once(spark):
    """the parts of a row come from one search, beside those that tell that it is a row (eight searches before)."""
    from obolus.plans.documents import ROW
    assert plan(spark, "ex05_refused_statements").count(ROW) <= 3
