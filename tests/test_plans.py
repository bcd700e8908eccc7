"""What Catalyst makes of the plans: pruned scans, few shuffles, no Python where none is needed."""

import re

import pytest

from cadenza import plans
from cadenza.plans import segmentation

QUERIES = plans.queries()
PYTHON = {"s03_edge_digest", "g02_similarity_fit", "a23_slope_search", "j14_slope_grid", "w15_lane_position", "x01_node_partition", "x02_weighted_lanes", "x03_plain_lanes"}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON))
def test_no_python_on_executors(spark, sf_dir, name):
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInArrow|MapInPandas|FlatMapGroups|CartesianProduct", physical(QUERIES[name](spark, sf_dir)))


@pytest.mark.parametrize("name,columns", [("w03_select_filter", {"event_id", "ts", "user_id"}), ("w09_rolling_median", {"event_id", "ts", "user_id", "value"}), ("a35_throughput", {"l_quantity", "l_tax", "l_returnflag"}), ("o06_first_n", {"doc_id", "n_chars"})])
def test_scans_are_pruned(spark, sf_dir, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", physical(QUERIES[name](spark, sf_dir)))
    assert schemas and {c.split(":")[0] for s in schemas for c in s.split(",")} <= columns


def test_filters_reach_the_scan(spark, sf_dir):
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,purchase\)", physical(QUERIES["p03_split_limit"](spark, sf_dir)))


def test_segmentation_shuffles_frames_once(spark, sf_dir, monkeypatch):
    class Unwritten:
        def __init__(self, *_):
            pass

        def keep(self, df, _):
            captured.append(df)
            return df

    captured = []
    monkeypatch.setattr(segmentation, "Scratch", Unwritten)
    QUERIES["segmentation"](spark, sf_dir)
    plan = physical(captured[0])
    assert plan.count("Exchange hashpartitioning(") == 1 and "Join" not in plan
