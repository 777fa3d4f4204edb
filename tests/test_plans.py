"""Physical-plan properties the scale design relies on (checked on executed plans)."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["trip_rollup", "trip_segmentation", "run_current_trips", "vehicle_summary",
                                  "fleet_summary", "segments", "unknown_vins", "ingest_outcomes"])
def test_no_nested_loops_or_python(spark, name):
    plan = final_plan(E.queries()[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, (name, bad)


def row_shuffles(df) -> list[str]:
    """Executed shuffles that carry whole fixes (their input has a latitude column)."""
    import contextlib
    import io

    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    txt = buf.getvalue()
    tree = txt.split("== Initial Plan ==")[0]
    final_ids = set(re.findall(r"\((\d+)\)", tree))
    out = []
    for block in txt.split("\n\n"):
        head = block.split("\n")[0]
        m = re.match(r"\((\d+)\)", head)
        if not m or m.group(1) not in final_ids:
            continue
        if "Exchange" in head and "Broadcast" not in head and "Reused" not in head:
            inputs = [ln for ln in block.split("\n") if ln.startswith("Input")]
            if inputs and re.search(r"\b(lat|latitude)#", inputs[0]):
                out.append(block)
    return out


@pytest.mark.parametrize("name", ["trip_rollup", "trip_segmentation", "segments", "running_average"])
def test_rows_shuffled_once(spark, name):
    """Fixes cross the network once; summaries move as small partial aggregates or reuse that shuffle."""
    shuffles = row_shuffles(E.queries()[name](spark, SF))
    assert len(shuffles) == 1, shuffles


def joins_of_rows(df) -> list[str]:
    """Executed joins with whole fixes on a side (a latitude column beside the fix's own time)."""
    import contextlib
    import io

    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    blocks = buf.getvalue().split("\n\n")
    return [b for b in blocks if re.match(r"\(\d+\) \w*Join", b) and re.search(r"\b(lat|latitude)#", b)]


def test_incremental_run_moves_rows_once_and_joins_none(spark):
    """Halo rows: one shuffle of the fixes for trips, alerts and marks, and no join of them, with open trips as seeds."""
    from geotrail.config import EVENTS_PARAMS
    from geotrail.plans.run import run_batch
    from geotrail.plans.scenarios import RUN2_AS_OF_MS, run_chain

    c = run_chain(spark, SF, EVENTS_PARAMS, upto=2)
    fixes = spark.createDataFrame(c.positions2.collect(), c.positions2.schema)
    res = run_batch(fixes, c.run1.current_trips, RUN2_AS_OF_MS, EVENTS_PARAMS)
    for out in (res.current_trips, res.completed_trips, res.speed_alerts, res.processed):
        assert len(row_shuffles(out)) == 1
        assert not joins_of_rows(out)


def test_scan_reads_only_needed_columns(spark):
    plan = final_plan(E.queries()["trip_rollup"](spark, SF))
    schemas = {ln.split("ReadSchema: ")[1].split(",")[0:3] and ln.split("ReadSchema: ")[1] for ln in plan.split("\n")
               if "ReadSchema: " in ln}
    assert schemas and all(s.startswith("struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>") for s in schemas)
