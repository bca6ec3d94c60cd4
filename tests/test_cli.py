"""The command-line jobs end to end on the sf0.01 stand-in."""

import pytest

from transitlens import cli
from transitlens.session import scratch_path
from transitlens.sources import standin
from transitlens.streaming import live as M

SF = "/root/testdata/sf0.01"


def test_jobs_end_to_end(spark):
    base = scratch_path(spark, "cli")
    standin.stop_documents(spark, SF).write.json(f"{base}/stops")
    standin.route_documents(spark, SF).write.json(f"{base}/routes")
    standin.payloads(spark, SF).write.json(f"{base}/landing")
    refs, raw, out, ckpt = f"{base}/refs", f"{base}/raw", f"{base}/view", f"{base}/ckpt"

    s = cli.main(["load-refs", "--stops", f"{base}/stops", "--routes", f"{base}/routes", "--out", refs])
    assert s["summary"] == "Reference data loaded: 25 stations, 10 routes, 11 lines"
    i = cli.main(["ingest", "--landing", f"{base}/landing", "--raw", raw, "--checkpoint", ckpt, "--once"])
    assert i["rows_inserted"] == 10000 and i["token"] == 10000 + i["rows_errored"] and i["payloads_skipped"] > 0
    with pytest.raises(RuntimeError):
        cli.main(["ingest", "--landing", f"{base}/landing", "--raw", f"{base}/raw2", "--checkpoint", f"{base}/ckpt2", "--once", "--strict"])
    v = cli.main(["view", "--raw", raw, "--refs", refs, "--out", out, "--checkpoint", ckpt, "--once"])
    assert v["trains"] == 764
    h = cli.main(["health", "--raw", raw, "--refs", refs, "--out", out])
    assert h["table_counts"]["RAW_ARRIVALS"] == 10000 and h["table_counts"]["REF_STATIONS"] == 25
    assert set(h["rejected"]) == {"timeToStation is not an integer", "unparseable payload"}
    # The loaded lines are the fixed eleven, none of which is a stand-in line:
    # positions then carry no colour, but are still placed.
    assert h["table_counts"]["TRAIN_POSITIONS"] == 764
    # nothing was reloaded, so nothing is placed again
    assert cli.main(["refresh", "--raw", raw, "--refs", refs, "--out", out])["rewritten"] == 0
    assert cli.main(["refresh", "--raw", raw, "--refs", refs, "--out", f"{base}/other"])["rewritten"] > 0
    assert M.read_positions(spark, f"{base}/other").exceptAll(M.read_positions(spark, out)).count() == 0
    assert cli.main(["health", "--raw", raw, "--refs", refs, "--out", out, "--max-age-min", "60"])["table_counts"]["TRAIN_POSITIONS"] == 0


def test_jobs_over_a_database(spark):
    base = scratch_path(spark, "cli-database")
    standin.stop_documents(spark, SF).write.json(f"{base}/stops")
    standin.route_documents(spark, SF).write.json(f"{base}/routes")
    standin.payloads(spark, SF).write.json(f"{base}/landing")
    raw, out, ckpt = f"{base}/raw", f"{base}/view", f"{base}/ckpt"
    load = ["load-refs", "--stops", f"{base}/stops", "--routes", f"{base}/routes", "--out", f"{base}/refs", "--database", "transit"]
    spark.sql(f"CREATE DATABASE transit LOCATION '{base}/transit'")
    try:
        assert cli.main(load) == cli.main(load) == {"summary": "Reference data loaded: 25 stations, 10 routes, 11 lines"}
        cli.main(["ingest", "--landing", f"{base}/landing", "--raw", raw, "--checkpoint", ckpt, "--once"])
        assert cli.main(["view", "--raw", raw, "--database", "transit", "--out", out, "--checkpoint", ckpt, "--once"])["trains"] == 764
        cli.main(load)
        assert cli.main(["refresh", "--raw", raw, "--database", "transit", "--out", out])["rewritten"] == 0
        counts = cli.main(["health", "--raw", raw, "--database", "transit", "--out", out])["table_counts"]
        assert (counts["REF_STATIONS"], counts["REF_LINE_ROUTES"], counts["REF_LINES"], counts["TRAIN_POSITIONS"]) == (25, 10, 11, 764)
        with pytest.raises(SystemExit):
            cli.main(["view", "--raw", raw, "--out", out, "--checkpoint", ckpt, "--once"])
    finally:
        spark.sql("DROP DATABASE transit CASCADE")
