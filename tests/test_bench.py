"""bench.py prints one JSON line with the fields the driver reads."""

import json


def test_bench_json_line(spark, monkeypatch, capsys):
    import bench
    monkeypatch.setenv("BENCH_SF_DIR", "/root/testdata/sf0.001")
    monkeypatch.setenv("BENCH_WARM_DIR", "/nonexistent")
    monkeypatch.setenv("BENCH_QUERIES", "r1_pivot_metrics,q2_anomaly_report")
    bench.main()
    lines = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("{")]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and rec["sf"] == "0.001"
    assert set(rec["queries"]) == {"r1_pivot_metrics", "q2_anomaly_report"}
    assert rec["value"] >= 0
