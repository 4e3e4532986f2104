"""Registered queries against DuckDB on the smallest scale. OBOLUS_ALL=1 runs every one."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
FEW = ("fn02_fold", "fn09_extract_amounts", "fn11_words_to_cents", "cl06_payee_class", "cl15_acceptance", "v12_yearly", "v13_counterparty_year",
       "v17_kae_reconciliation", "v22_budget_month", "v24_grant_to_date", "v28_payment_combined", "v29_supplier_year_combined", "rp26_reconciliation_matrix",
       "jn04_full_outer_null_keys", "jn08_interval_anti_join", "wn01_top_n_per_group", "rg02_payment_rows", "rg08_split_by_share", "src07_land_versioned",
       "qg06_check_search_page", "dq02_retyped_posting", "pv02_name_leaks", "st01_land_stream", "ex16_section_tables", "ag17_counterparties")
NAMES = sorted(entry.oracle_sql()) if os.environ.get("OBOLUS_ALL") else FEW


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    res, _, _ = compare(spark, duck, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert res.startswith("ok"), res


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["entity", "year", "n_suppliers", "supplier_eur", "top10_share", "top1_share"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
