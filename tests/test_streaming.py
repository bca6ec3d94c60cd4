"""M1-M5: the live view equals the batch view."""

import datetime as dt
import json
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from transitlens.operators.latest import latest_per_vehicle
from transitlens.plans.positions import prune_raw, train_positions
from transitlens.session import scratch_path, shared_dir
from transitlens.sources import ingest as I
from transitlens.sources import refdata as R
from transitlens.sources import standin
from transitlens.streaming import live as M
from transitlens.streaming import commits as C

SF = "/root/testdata/sf0.01"
NOW = {"availableNow": True}


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def landing_parts(spark):
    """Stand-in payloads written as 6 landing folders (by payload chunk)."""
    base = scratch_path(spark, "landing-parts")
    pays = standin.payloads(spark, SF).withColumn("part", F.abs(F.xxhash64("body")) % 6)
    pays.write.partitionBy("part").json(base)
    return [os.path.join(base, d) for d in sorted(os.listdir(base)) if d.startswith("part=")]


def _feed(landing_dir, parts, order):
    # Move nothing: copy the part files into the watched folder in the given order.
    import shutil
    for i in order:
        for f in os.listdir(parts[i]):
            if f.endswith(".json"):
                shutil.copy(os.path.join(parts[i], f), os.path.join(landing_dir, f"p{i}-{f}"))


def test_stream_equals_batch_with_restart_and_shuffled_order(spark, landing_parts):
    base = scratch_path(spark, "live-test")
    landing, raw_dir, out, ckpt = (f"{base}/{n}" for n in ("landing", "raw", "positions", "ckpt"))
    os.makedirs(landing)
    st_path, ln_path = f"{base}/stations", f"{base}/lines"
    R.replace_table(standin.stations(spark, SF), st_path)
    R.replace_table(standin.lines(spark, SF), ln_path)
    order = list(range(len(landing_parts)))
    random.Random(3).shuffle(order)

    # First run sees half of the files; then a restart from the same checkpoints.
    _feed(landing, landing_parts, order[:3])
    M.ingest_available(spark, landing, raw_dir, ckpt)
    M.run_available(M.start_positions(spark, raw_dir, st_path, ln_path, out, ckpt, NOW))
    first = M.read_positions(spark, out).count()

    _feed(landing, landing_parts, order[3:])
    M.ingest_available(spark, landing, raw_dir, ckpt)
    M.run_available(M.start_positions(spark, raw_dir, st_path, ln_path, out, ckpt, NOW))

    t = standin.reference_tables(spark, SF)
    batch = train_positions(t["raw"], t["stations"], t["lines"])
    live = M.read_positions(spark, out)
    assert live.count() == 764 and first > 0
    assert _same(live.select(*batch.columns), batch)
    # Raw written by the stream is the stand-in raw table, no row twice.
    assert _same(I.read_raw(spark, raw_dir).drop("ingest_date").select(*t["raw"].columns), t["raw"])


def _references(spark, base, stations=None):
    paths = f"{base}/stations", f"{base}/lines"
    R.replace_table(standin.stations(spark, SF) if stations is None else stations, paths[0])
    R.replace_table(standin.lines(spark, SF), paths[1])
    return paths


def _files(out):
    """bucket -> its files"""
    return {d: sorted(f for f in os.listdir(f"{out}/{d}") if f.endswith(".parquet")) for d in os.listdir(out) if d.startswith("bucket=")}


def _scratch(spark):
    return {d for d in os.listdir(shared_dir(spark)) if d.startswith(("parsed-", "name-matches-", "changed-", "rows-"))}


def test_refresh_after_reference_reload(spark):
    base = scratch_path(spark, "refresh-test")
    raw_dir, out = f"{base}/raw", f"{base}/positions"
    I.append_raw(standin.arrivals(spark, SF), raw_dir)
    paths = _references(spark, base)
    assert len(M.refresh(spark, raw_dir, *paths, out)) > 0
    assert M.read_positions(spark, out).count() == 764
    assert M.refresh(spark, raw_dir, *paths, out) == []
    _references(spark, base)                              # the same rows in new files are no new version
    assert M.refresh(spark, raw_dir, *paths, out) == []
    # Reload stations without line 'asia': its name matches disappear, and nothing else reads raw.
    _references(spark, base, standin.stations(spark, SF).where("line_id <> 'asia'"))
    M.refresh(spark, f"{base}/no-raw-needed", *paths, out)
    want = train_positions(standin.arrivals(spark, SF), standin.stations(spark, SF).where("line_id <> 'asia'"), standin.lines(spark, SF))
    assert M.read_positions(spark, out).where("line_id = 'asia'").count() == 0 and _same(M.read_positions(spark, out), want)


def test_a_trigger_rewrites_the_buckets_of_changed_keys_only(spark, monkeypatch):
    base = scratch_path(spark, "buckets")
    raw_dir, out, ckpt = f"{base}/raw", f"{base}/view", f"{base}/ckpt"
    paths, raw = _references(spark, base), standin.arrivals(spark, SF)
    I.append_raw(raw, raw_dir)
    M.run_available(M.start_positions(spark, raw_dir, *paths, out, ckpt, NOW))
    before, keys = _files(out), raw.select("vehicle_id", "line_id").distinct()
    # about 1 % of the keys get a newer prediction
    some = [tuple(r) for r in keys.orderBy("vehicle_id", "line_id").limit(max(3, keys.count() // 100)).collect()]
    newer = raw.where(F.struct("vehicle_id", "line_id").isin([F.struct(F.lit(a), F.lit(b)) for a, b in some]))
    newer = latest_per_vehicle(newer)                      # one row a key, the same each time it is read
    newer = newer.withColumn("timestamp_utc", F.lit("2024-03-01").cast("timestamp_ntz")).withColumn("current_location", F.lit("At NATION_1"))
    newer = newer.orderBy("event_id").withColumn("event_id", F.col("event_id") + 1_000_000)
    I.append_raw(newer, raw_dir)
    placed_rows = []
    real = M.placed
    monkeypatch.setattr(M, "placed", lambda latest, *a: placed_rows.append(latest.count()) or real(latest, *a))
    M.run_available(M.start_positions(spark, raw_dir, *paths, out, ckpt, NOW))
    after = _files(out)
    touched = {f"bucket={r[0]}" for r in newer.select(M.bucket(M.BUCKETS)).distinct().collect()}
    assert {d for d in after if after[d] != before.get(d)} == touched and len(touched) < len(after) / 4
    assert placed_rows == [len(some)]                      # the joins read the changed rows only
    want = train_positions(raw.unionByName(newer), standin.stations(spark, SF), standin.lines(spark, SF))
    assert _same(M.read_positions(spark, out), want)


def test_ten_triggers_leave_no_scratch_table(spark):
    base = scratch_path(spark, "triggers")
    raw_dir, out = f"{base}/raw", f"{base}/view"
    paths, raw = _references(spark, base), standin.arrivals(spark, SF)
    raw.withColumn("rejected", F.lit(False)).withColumn("ingest_date", F.to_date("timestamp_utc")).repartition(10).write.parquet(raw_dir)
    before = _scratch(spark)
    q = M.start_positions(spark, raw_dir, *paths, out, f"{base}/ckpt", NOW, max_files_per_trigger=1, buckets=8)
    M.run_available(q)
    assert q.lastProgress["batchId"] >= 9
    assert _scratch(spark) == before and not os.listdir(f"{out}.staged")
    want = train_positions(raw, standin.stations(spark, SF), standin.lines(spark, SF))
    assert _same(M.read_positions(spark, out), want)


def test_a_reload_between_triggers_shows_in_all_rows(spark):
    base = scratch_path(spark, "reload-test")
    raw_dir, out, ckpt = f"{base}/raw", f"{base}/view", f"{base}/ckpt"
    raw, late = standin.arrivals(spark, SF), F.col("event_id") % 50 == 0
    I.append_raw(raw.where(~late), raw_dir)
    paths = _references(spark, base, standin.stations(spark, SF).withColumn("latitude", F.col("latitude") + 1))
    M.run_available(M.start_positions(spark, raw_dir, *paths, out, ckpt, NOW))
    I.append_raw(raw.where(late), raw_dir)
    _references(spark, base)
    M.run_available(M.start_positions(spark, raw_dir, *paths, out, ckpt, NOW))
    want = train_positions(raw, standin.stations(spark, SF), standin.lines(spark, SF))
    assert _same(M.read_positions(spark, out), want)


def test_the_live_view_follows_switched_catalog_tables(spark):
    """Another session switches a table between triggers; the view's session sees it, and folders give the same rows."""
    base, tag = scratch_path(spark, "switched"), uuid.uuid4().hex[:8]
    raw_dir, out, ckpt, refs = f"{base}/raw", f"{base}/view", f"{base}/ckpt", f"{base}/refs"
    names = f"stations_{tag}", f"lines_{tag}"
    raw, late = standin.arrivals(spark, SF), F.col("event_id") % 50 == 0
    I.append_raw(raw.where(~late), raw_dir)
    R.switch_table(standin.stations(spark, SF).withColumn("latitude", F.col("latitude") + 1), names[0], refs)
    R.switch_table(standin.lines(spark, SF), names[1], refs)
    try:
        M.run_available(M.start_positions(spark, raw_dir, *names, out, ckpt, NOW))
        assert M.refresh(spark, raw_dir, *names, out) == []
        R.switch_table(standin.stations(spark.newSession(), SF), names[0], refs)
        I.append_raw(raw.where(late), raw_dir)
        M.run_available(M.start_positions(spark, raw_dir, *names, out, ckpt, NOW))
        want = train_positions(raw, standin.stations(spark, SF), standin.lines(spark, SF))
        assert _same(M.read_positions(spark, out), want)
        assert M.refresh(spark, raw_dir, *_references(spark, base), out) == []      # the same rows are the same version
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_merge_that_fails_half_way_goes_on_from_its_staged_rows(spark, monkeypatch):
    base = scratch_path(spark, "crash")
    out = f"{base}/view"
    rows = spark.createDataFrame([(f"v{i}", "x", i) for i in range(40)], "vehicle_id string, line_id string, n int")
    M.merge_changes(rows, out, lambda r: r, "", "b0", buckets=8)
    changed = rows.where("n < 20").withColumn("n", F.col("n") + 100)
    with monkeypatch.context() as m:
        m.setattr(M, "remove", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            M.merge_changes(changed, out, lambda r: r, "", "b1", buckets=8)
    # a bucket is lost, as if the driver had died between its removal and its replacement
    gone = sorted(_files(out))[0]
    M.remove(spark, f"{out}/{gone}")
    M.merge_changes(changed, out, lambda r: r, "", "b1", buckets=8)
    assert _same(M.read_view(spark, out), rows.where("n >= 20").unionByName(changed))


def test_null_keys_are_keys(spark):
    out = f"{scratch_path(spark, 'nulls')}/view"
    frame = lambda rows: spark.createDataFrame(rows, "vehicle_id string, line_id string, n int")
    M.merge_changes(frame([(None, "x", 1), ("", "x", 2), (None, None, 3)]), out, lambda r: r, "", "b0")
    M.merge_changes(frame([(None, "x", 4), (None, None, 5)]), out, lambda r: r, "", "b1")
    assert sorted(r.n for r in M.read_view(spark, out).collect()) == [2, 4, 5]
    assert M.merge_changes(frame([]), out, lambda r: r, "", "b2") == []
    with pytest.raises(FileNotFoundError):
        M.read_view(spark, f"{out}-none")


def test_max_age_leaves_out_stale_vehicles(spark):
    base = scratch_path(spark, "fresh-test")
    raw_dir, out = f"{base}/raw", f"{base}/positions"
    I.append_raw(standin.arrivals(spark, SF), raw_dir)
    M.run_available(M.start_positions(spark, raw_dir, *_references(spark, base), out, f"{base}/ckpt", NOW))
    # Stand-in timestamps are in January 2024
    assert M.read_positions(spark, out).count() == 764
    assert M.read_positions(spark, out, dt.timedelta(days=1)).count() == 0
    kept = M.read_positions(spark, out, dt.timedelta(days=10), dt.datetime(2024, 1, 31))
    assert 0 < kept.count() < 764 and kept.agg(F.min("timestamp_utc")).first()[0] >= dt.datetime(2024, 1, 21)


def test_ingest_in_bounded_batches_with_archive(spark, landing_parts):
    base = scratch_path(spark, "bounded")
    landing, raw_dir, ckpt, archive = (f"{base}/{n}" for n in ("landing", "raw", "ckpt", "archive"))
    os.makedirs(landing)
    _feed(landing, landing_parts, range(len(landing_parts)))
    n_files = len(os.listdir(landing))
    q = M.start_ingest(spark, landing, raw_dir, ckpt, NOW, max_files_per_trigger=2,
                       clean_source="archive", archive_dir=archive)
    M.run_available(q)
    assert q.lastProgress is not None and q.lastProgress["batchId"] >= (n_files + 1) // 2 - 1
    want = standin.arrivals(spark, SF)
    assert _same(I.read_raw(spark, raw_dir).drop("ingest_date").select(*want.columns), want)


def test_rejects_and_archive_lose_nothing(spark):
    """Twelve files, one per trigger, archived as they are read: every row is in the table, good or rejected."""
    base = scratch_path(spark, "rejects")
    landing = f"{base}/landing"
    os.makedirs(landing)
    for i in range(12):
        with open(f"{landing}/f{i:02d}.json", "w") as f:
            for body in ([{"id": str(i), "vehicleId": f"v{i}", "lineId": "x"}, {"id": str(i), "timeToStation": "soon"}], None):
                f.write(json.dumps({"ingestion_id": "r", "timestamp_utc": "2024-01-01T00:00:00", "line_id": "x",
                                    "body": json.dumps(body) if body else "[{broken"}) + "\n")
    args = (spark, landing, f"{base}/raw", f"{base}/ckpt")
    with pytest.raises(RuntimeError, match="rejected 12 rows"):
        M.ingest_available(*args, strict=True, max_files_per_trigger=1, clean_source="archive", archive_dir=f"{base}/done")
    assert I.read_raw(spark, f"{base}/raw").count() == 12
    rejects = I.read_rejects(spark, f"{base}/raw").groupBy("reject_reason").count().collect()
    assert {r.reject_reason: r["count"] for r in rejects} == {"timeToStation is not an integer": 12, "unparseable payload": 12}
    # a second run over nothing new adds nothing and does not fail
    again = M.ingest_available(*args, strict=True, max_files_per_trigger=1, clean_source="archive", archive_dir=f"{base}/done")
    assert again == {"rows_inserted": 0, "rows_errored": 0, "payloads_skipped": 0, "token": 24}
    assert I.read_raw(spark, f"{base}/raw").count() == 12
    commits = [tuple(r) for r in C.read_commits(spark, f"{base}/ckpt/commits").orderBy("batch").collect()]
    assert commits == [(i, 2 * (i + 1), 1, 1, 1) for i in range(12)]


def test_a_day_gets_few_files_however_many_tasks_parse_it(spark):
    """Twelve landing files over three days, each read by a task of its own."""
    base = scratch_path(spark, "by-day")
    landing, raw_dir = f"{base}/landing", f"{base}/raw"
    os.makedirs(landing)
    for i in range(12):
        with open(f"{landing}/f{i:02d}.json", "w") as f:
            for day in (1, 2, 3):
                body = [{"id": str(3 * i + day), "vehicleId": f"v{i}", "lineId": "x"}, {"id": str(i), "timeToStation": "soon"}]
                f.write(json.dumps({"ingestion_id": "r", "timestamp_utc": f"2024-01-0{day}T00:00:00", "line_id": "x", "body": json.dumps(body)}) + "\n")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        totals = M.ingest_available(spark, landing, raw_dir, f"{base}/ckpt")
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert (totals["rows_inserted"], totals["rows_errored"]) == (36, 36)
    days = [d for d, _, files in os.walk(raw_dir) for f in files if "ingest_date=" in d and f.endswith(".parquet")]
    assert len(days) == len(set(days)) == 6
    good = spark.read.parquet(raw_dir).where("NOT rejected")
    assert good.count() == 36 and good.where("prediction_json IS NOT NULL OR reject_reason IS NOT NULL").count() == 0
    assert I.read_rejects(spark, raw_dir).where("prediction_json LIKE '%soon%'").count() == 36


def test_the_folded_query_reads_raw_in_several_batches(spark, monkeypatch):
    from transitlens.plans.registry import QUERIES
    merges, real = [], M.merge_changes
    monkeypatch.setattr(M, "merge_changes", lambda *a: merges.append(real(*a)))
    got = QUERIES["stream_positions_folded"](spark, SF)
    assert 3 <= len(merges) <= 5
    want = train_positions(standin.arrivals(spark, SF), standin.stations(spark, SF), standin.lines(spark, SF))
    assert _same(got.select(*want.columns), want)


def _land(landing, name, n):
    os.makedirs(landing, exist_ok=True)
    with open(f"{landing}/.{name}", "w") as f:
        f.write(json.dumps({"ingestion_id": "r", "timestamp_utc": "2024-01-01T00:00:00", "line_id": "x",
                            "body": json.dumps([{"id": str(i), "vehicleId": f"{name}-{i}", "lineId": "x"} for i in range(n)])}) + "\n")
    os.rename(f"{landing}/.{name}", f"{landing}/{name}")


def test_wait_for_commit(spark):
    base = scratch_path(spark, "wait")
    _land(f"{base}/landing", "a.json", 3)
    q = M.start_ingest(spark, f"{base}/landing", f"{base}/raw", f"{base}/ckpt", {"processingTime": "200 milliseconds"})
    try:
        assert q.commits.wait_for(3, 60) == 3
        _land(f"{base}/landing", "b.json", 4)
        assert q.commits.wait_for(7, 60) == 7
        assert I.read_raw(spark, f"{base}/raw").count() == 7
        with pytest.raises(TimeoutError, match="7 of 8 rows"):
            q.commits.wait_for(8, 1)
    finally:
        q.stop()
    assert q.commits.finished()["token"] == 7
    with pytest.raises(TimeoutError, match="has ended"):
        q.commits.wait_for(8, 60)


def test_two_ingests_at_once_count_their_own_rows(spark):
    bases = [scratch_path(spark, "twin") for _ in range(2)]
    for i, base in enumerate(bases):
        _land(f"{base}/landing", "a.json", 3 + i)
    queries = [M.start_ingest(spark, f"{b}/landing", f"{b}/raw", f"{b}/ckpt", NOW) for b in bases]
    M.run_available(queries)
    assert [q.commits.finished()["rows_inserted"] for q in queries] == [3, 4]


def test_polls_go_on_after_the_last_cycle(spark):
    base = scratch_path(spark, "polls-test")
    landing = f"{base}/landing"
    run = lambda: M.ingest_available(spark, landing, f"{base}/raw", f"{base}/ckpt", polls=True)
    for cycle in (1, 2, 10):
        for line in ("x.json", "y.json"):
            _land(f"{landing}/cycle={cycle}", line, 2)
    assert run()["rows_inserted"] == 12
    assert run()["rows_inserted"] == 0
    _land(f"{landing}/cycle=2", "z.json", 5)                # a cycle is whole when it lands: not read again
    _land(f"{landing}/cycle=11", "x.json", 2)
    _land(f"{landing}/cycle=12.part", "x.json", 9)          # not in place yet
    assert run() == {"rows_inserted": 2, "rows_errored": 0, "payloads_skipped": 0, "token": 14}
    assert I.read_polls(spark, landing).count() == 8
    # a restart in mid-run: the offsets are written, the batch is not committed
    _land(f"{landing}/cycle=12", "x.json", 1)
    run()
    commits = f"{base}/ckpt/raw/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{f}"):
            os.remove(f"{commits}/{f}")
    _land(f"{landing}/cycle=13", "x.json", 1)
    run()                                                   # the batch again, with the cycles it had
    run()
    rows = I.read_raw(spark, f"{base}/raw")
    assert rows.count() == 12 + 2 + 1 + 1


def test_polls_with_an_empty_or_missing_folder(spark):
    base = scratch_path(spark, "polls-none")
    assert I.read_polls(spark, f"{base}/landing").count() == 0
    assert M.ingest_available(spark, f"{base}/landing", f"{base}/raw", f"{base}/ckpt", polls=True)["token"] == 0


def test_refresh_sees_late_days_and_null_timestamps(spark):
    base = scratch_path(spark, "late")
    raw_dir, out, ckpt = f"{base}/raw", f"{base}/view", f"{base}/ckpt"
    st_path, ln_path = f"{base}/stations", f"{base}/lines"
    R.replace_table(standin.stations(spark, SF), st_path)
    R.replace_table(standin.lines(spark, SF), ln_path)
    raw = standin.arrivals(spark, SF)
    raw = raw.withColumn("timestamp_utc", F.when(F.col("event_id") % 13 != 0, F.col("timestamp_utc")))
    late = F.col("timestamp_utc").isNull() | (F.col("timestamp_utc") < F.lit("2024-01-10").cast("timestamp_ntz"))
    for part in (raw.where(~late), raw.where(late)):
        I.append_raw(part, raw_dir)
        M.run_available(M.start_positions(spark, raw_dir, st_path, ln_path, out, ckpt, NOW))
    want = train_positions(raw, standin.stations(spark, SF), standin.lines(spark, SF))
    assert _same(M.read_positions(spark, out), want)


def test_null_id_ties_give_one_answer_in_batch_and_stream(spark):
    base = scratch_path(spark, "ties")
    raw = (standin.arrivals(spark, SF).withColumn("event_id", F.lit(None).cast("long"))
           .withColumn("time_to_station", F.lit(60)).withColumn("platform_name", F.concat(F.lit("P"), F.col("destination_naptan_id"))))
    I.append_raw(raw.orderBy(F.rand(3)).repartition(7), f"{base}/raw")
    M.run_available(M.start_view(spark, f"{base}/raw", f"{base}/out", f"{base}/ckpt", trigger=NOW))
    stream = M.read_view(spark, f"{base}/out")
    for seed in (1, 2):
        batch = latest_per_vehicle(raw.orderBy(F.rand(seed)).repartition(11))
        assert _same(stream.select(*batch.columns), batch)
        pruned = latest_per_vehicle(prune_raw(raw.orderBy(F.rand(seed)).repartition(5)))
        assert _same(pruned, batch.select(*pruned.columns))
