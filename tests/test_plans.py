"""What the plans must and must not contain."""

import re

import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_no_pairs_and_no_whole_table_window(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    for window in re.findall(r"Window \[(.*)\]", text):
        assert "windowspecdefinition(" in window
    # a single partition only ever holds partial aggregates
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "Aggregate" in lines[i - 1] and "partial_" in lines[i + 1], line


def test_flagship_reads_three_of_eleven_columns(spark):
    text = plan(contract.queries()["recon_checks"](spark, SF))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?lineitem", text)
    assert scans and all(len(s.split(",")) <= 4 for s in scans)


def test_filters_reach_the_scan(spark):
    text = plan(contract.queries()["set_difference"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_returnflag), Not(EqualTo(l_returnflag,N))]" in text


def test_one_row_per_key_is_limited_before_the_shuffle(spark):
    text = plan(contract.queries()["dedupe_best_read"](spark, SF))
    before = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_reconciliation_shuffles_entries_once(spark):
    """Entries are aggregated before their one shuffle, and no join shuffles them again."""
    from snapledger.operators.reconcile import entry_counts
    from snapledger.queries.registry import Tables

    li = Tables(spark, SF).lineitem.selectExpr("l_orderkey as roll_id", "'active' as entry_status", "'Male' as gender")
    text = plan(entry_counts(li))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text[text.index("Exchange"):]
