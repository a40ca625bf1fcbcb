"""Plan-shape regression: the scale properties of the registered queries.

Uses the same summary as scripts/plan_report.py (explain("formatted") text).
"""

from __future__ import annotations

import importlib.util
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
_spec = importlib.util.spec_from_file_location(
    "plan_report", os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts",
                                "plan_report.py"))
plan_report = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(plan_report)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def summary(spark, name):
    return plan_report.summarise(plan_report.plan_text(entry.queries()[name](spark, SF)))


@pytest.mark.parametrize("name", ["file_catalogue", "legacy_ids", "archive_dest", "subdir_rule",
                                  "one_level_rule", "flatten_deep", "select_labels", "lineitem_catalogue"])
def test_projection_queries_do_not_shuffle_or_read_bodies(spark, name):
    s = summary(spark, name)
    assert s["shuffles"] == "0" and s["python"] == "-"
    assert "text" not in s["scans"].split("|")[0].split(",")


@pytest.mark.parametrize("name", ["type_counts_a1", "type_counts_a2", "type_counts_long", "check_constraints",
                                  "catalogue_datasets"])
def test_reports_are_one_aggregation(spark, name):
    s = summary(spark, name)
    assert s["shuffles"] == "1" and s["joins"] == "-" and s["python"] == "-"


def test_label_join_broadcasts_only_the_checked_side(spark):
    s = summary(spark, "meta_info")
    assert s["joins"] == "BroadcastHashJoin" and s["broadcasts"] == "1" and s["shuffles"] == "0"


def test_python_only_in_archive_expansion(spark):
    assert summary(spark, "expand_archives")["python"] == "MapInPandas"


def test_columns_reach_the_scans(spark):
    # each of the three tables once, with the columns asked for
    assert summary(spark, "union_labels")["scans"] == "doc_id,quality,toxic; p_partkey,p_brand; conv_id,turn,role"
    assert "partitions:" in summary(spark, "partitioned_catalogue")["scans"]
