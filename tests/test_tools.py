"""The event-log summary of tools/stage_times.py, on a small hand-written log."""

import importlib.util
import json
import os
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _load_tool():
    spec = importlib.util.spec_from_file_location("stage_times", os.path.join(REPO, "tools", "stage_times.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def _task(stage, ms, shuffle_write=0, records=0):
    return {
        "Event": "SparkListenerTaskEnd", "Stage ID": stage, "Stage Attempt ID": 0,
        "Task Info": {"Launch Time": 1000, "Finish Time": 1000 + ms},
        "Task Metrics": {
            "Input Metrics": {"Bytes Read": 2**20, "Records Read": records},
            "Shuffle Read Metrics": {"Remote Bytes Read": 0, "Local Bytes Read": 0},
            "Shuffle Write Metrics": {"Shuffle Bytes Written": shuffle_write},
            "Disk Bytes Spilled": 0,
        },
    }


def _stage(stage, name, submitted, completed):
    return {"Event": "SparkListenerStageCompleted", "Stage Info": {
        "Stage ID": stage, "Stage Attempt ID": 0, "Stage Name": f"{name} at x.py:1",
        "Submission Time": submitted, "Completion Time": completed}}


def test_rolling_event_log_summary():
    tool = _load_tool()
    with tempfile.TemporaryDirectory() as log:
        # a rolling log: events are split over numbered files, read in number order
        first = [_task(0, 100, shuffle_write=2**20, records=10), _task(0, 300, records=30)]
        second = [_stage(0, "collect", 0, 400), _task(1, 50), _stage(1, "collect", 400, 460)]
        for n, events in ((1, first), (2, second)):
            with open(os.path.join(log, f"events_{n}_app"), "w") as fh:
                fh.write("\n".join(json.dumps(e) for e in events) + "\n")
        rows = tool._stage_rows(log)
    assert [(r["stage"], r["tasks"], r["wall_ms"], r["max_ms"]) for r in rows] == [(0, 2, 400, 300), (1, 1, 60, 50)]
    assert rows[0]["median_ms"] == 200 and rows[0]["input_records"] == 40
    assert rows[0]["shuffle_write_mb"] == 1.0 and rows[0]["name"] == "collect"
