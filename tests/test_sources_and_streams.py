import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklode.functions import vision as V
from tracklode.sources import readers as R
from tracklode.sources import sinks as K
from tracklode.streaming import progress as T


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'say "hi"', ["x", "y"]), ("line\nbreak", None, [])], "p string, q string, l array<string>")
    K.write_csv(df, f"{tmp_path}/t", ["q", "p", "l", "missing"])
    back = R.read_csv(spark, f"{tmp_path}/t")
    assert back.columns == ["q", "p", "l", "missing"]
    assert sorted(map(tuple, back.collect())) == [("", "line\nbreak", "", ""), ('say "hi"', "a,b", "x;y", "")]


def test_table_fallbacks(spark, tmp_path):
    form = "a string, b string"
    df = spark.createDataFrame([("1", None)], form)
    assert R.read_table(spark, f"{tmp_path}/none.parquet", form).count() == 0
    K.write_csv(df, f"{tmp_path}/t.csv")
    assert tuple(R.read_table(spark, f"{tmp_path}/t.parquet", form).first()) == ("1", "")
    K.write_json(spark, f"{tmp_path}/p.fallback.json", {"path": f"{tmp_path}/t.csv"})
    assert R.read_table(spark, f"{tmp_path}/p.parquet", form).count() == 1
    K.write_table(df, f"{tmp_path}/t.parquet")
    assert tuple(R.read_table(spark, f"{tmp_path}/t.parquet", form).first()) == ("1", "")
    with pytest.raises(FileNotFoundError):
        R.read_required(spark, f"{tmp_path}/none.csv")


def test_json_and_yaml(spark, tmp_path):
    value = {"a": [1, {"b": "x: y"}], "c": {}, "d": [], "e": None, "f": True, "g": {"h": "é"}}
    K.write_json(spark, f"{tmp_path}/v.json", value)
    assert R.read_json(spark, f"{tmp_path}/v.json") == value and R.read_json(spark, f"{tmp_path}/none.json", 3) == 3
    yaml = pytest.importorskip("yaml")
    assert yaml.safe_load(K.to_yaml(value)) == value
    K.write_yaml(spark, f"{tmp_path}/v.yaml", value)
    assert R.read_yaml(spark, f"{tmp_path}/v.yaml") == value
    K.append_jsonl(spark.range(2), f"{tmp_path}/l")
    K.append_jsonl(spark.range(3), f"{tmp_path}/l")
    assert R.read_jsonl(spark, f"{tmp_path}/l", "id long").count() == 5 and R.read_jsonl(spark, f"{tmp_path}/none", "id long").count() == 0


def test_files_by_status_and_archive(spark, tmp_path):
    df = spark.createDataFrame([(1, "PASS", ""), (2, "REJECT", "bad"), (3, "PASS", "")], "id int, s string, why string")
    K.write_by_status(df, f"{tmp_path}/s", "s")
    assert {p.name for p in (tmp_path / "s").glob("s=*")} == {"s=PASS", "s=REJECT"}
    K.write_accepted_and_rejected(df, f"{tmp_path}/r", "why")
    assert spark.read.parquet(f"{tmp_path}/r/accepted").count() == 2 and spark.read.parquet(f"{tmp_path}/r/rejected").first().why == "bad"
    K.archive(spark, {"m.jsonl": df}, f"{tmp_path}/m.tar.gz")
    with tarfile.open(tmp_path / "m.tar.gz") as tar:
        assert len([json.loads(x) for x in tar.extractfile("m.jsonl").read().decode().splitlines()]) == 3
    assert "| 1 | PASS |" in K.report("t", {"rows": df.orderBy("id"), "text": "x"})
    assert K.save_labels(df, f"{tmp_path}/labels", 20).startswith(f"{tmp_path}/labels/backup-")


def test_listing_and_npy(spark, tmp_path):
    for p in ("val/hdf5/episode1.npy", "val_videos_1/x.npy", "root.npy"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        np.save(tmp_path / p, np.arange(6.0).reshape(3, 2))
    files = R.listing(spark, str(tmp_path), "*.npy")
    assert files.count() == 3
    assert sorted((r.dataset, r.kind, r.files) for r in R.datasets(files, str(tmp_path)).collect()) == [("val", "split", 1), ("val_videos_1", "video", 1)]
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path / "val")).union(spark.createDataFrame([("bad", None, 0, bytearray(b"?"))], "path string, modificationTime timestamp, length long, content binary"))
    rows = R.decode_files(raw, R.decode_npy, "path string, t int, joint array<double>").orderBy("t").collect()
    assert [r.joint for r in rows] == [[0.0, 1.0], [2.0, 3.0], [4.0, 5.0]]
    names = spark.createDataFrame([("e/pick.py",), ("e/_x.py",), ("pick.json",), ("b.txt",)], "path string")
    assert [r.task for r in R.tasks(names).collect()] == ["pick"]


def clip(n, change):
    frames = []
    for k in range(n):
        f = np.full((120, 160, 3), 210, np.uint8)
        change(f, k)
        frames.append(f)
    return frames


def test_flicker_tells_foreground_from_exposure():
    """Two clips: an object that slides in, and a jump of exposure."""

    def enter(f, k):
        f[30:90, : max(0, (k - 4) * 8)] = 40

    def jump(f, k):
        f[:] = 210 if k < 12 else 245

    a, b = V.background_flicker(clip(24, enter)), V.background_flicker(clip(24, jump))
    assert a["global_luma_step"] > 3 and a["global_rgb_shift"] > 15 and a["background_luma_flicker"] < 6 and not a["candidate"]
    assert b["background_luma_flicker"] > 8 and b["changed_area"] > 0.55 and b["candidate"]


def test_picture_statistics(spark):
    f = np.zeros((16, 16, 3), np.uint8)
    f[:, 8:] = 200
    s = V.image_stats(f)
    assert s["brightness"] == pytest.approx(100) and s["contrast"] == pytest.approx(100) and s["saturation"] == 0 and s["edge_density"] > 0
    assert V.blockiness(V.gray(f)) > 50 and V.blockiness(np.zeros((16, 16))) == 0 and V.frame_similarity(f, f) == 1 and V.motion_score([f, 255 - f]) > 0.5
    density, _ = np.histogram(V.gray(f), bins=256, range=(0, 255), density=True)
    assert V.entropy(V.gray(f)) == pytest.approx(-sum(p * np.log2(p) for p in density if p))
    df = spark.createDataFrame([(16, 16, bytearray(f.tobytes()))], "h int, w int, p binary")
    assert df.select(V.image_stats_udf("h", "w", "p").alias("s")).first().s.brightness == pytest.approx(100)
    lit = F.lit
    assert tuple(spark.range(1).select(V.visual_sanity(lit(0.95), lit(0.01), lit(1)), V.visual_sanity(lit(0.01), lit(0.5), lit(1)), V.visual_sanity(lit(0.5), lit(0.5), lit(0)), V.visual_sanity(lit(0.5), lit(0.5), lit(1))).first()) == ("FAIL_white", "FAIL_dark", "FAIL_empty", "OK")


def test_leaders_against_a_loop(spark):
    import random

    rnd = random.Random(1)
    codes = ["".join(rnd.choice("01") for _ in range(12)) for _ in range(60)]
    leaders, want = [], {}
    for i, c in enumerate(codes):
        near = [j for j, k in leaders if sum(a != b for a, b in zip(c, k)) <= 3]
        want[i] = near[0] if near else i
        if not near:
            leaders.append((i, c))
    df = spark.createDataFrame(list(enumerate(codes)), "i int, c string").repartition(3)
    assert {r.i: r.group_id for r in V.leader_groups(df, "i", "c", 3).collect()} == want


def test_streams(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = T.arriving(spark, f"{tmp_path}/in", events, files=1)
    out = T.run_once(T.sliding(stream, "ts", "2 hours", "1 hour", ["event_type"], "value"), "complete", f"{tmp_path}/c1")
    assert out.agg(F.sum("n")).first()[0] == 2 * events.count()
    T.append_new(stream, "event_id", f"{tmp_path}/sink", lambda df: df.select("event_id"), f"{tmp_path}/c2")
    T.append_new(stream, "event_id", f"{tmp_path}/sink", lambda df: df.select("event_id"), f"{tmp_path}/c3")
    assert spark.read.parquet(f"{tmp_path}/sink").count() == events.select("event_id").distinct().count()
    T.run_to(T.distinct_events(stream, "ts", "user_id", "3650 days").select("user_id"), f"{tmp_path}/users", f"{tmp_path}/c4")
    assert spark.read.parquet(f"{tmp_path}/users").count() == events.select("user_id").distinct().count()
    assert T.run_once(T.sessions(stream, "ts", "30 minutes", ["user_id"], "3650 days"), "complete", f"{tmp_path}/c5").agg(F.sum("n")).first()[0] == events.count()


def test_retries():
    answers = iter(["bad", "worse", "ok"])
    assert T.retried(lambda p: next(answers), "p", lambda a: a == "ok", "again") == "ok"
    assert T.retried(lambda p: "bad", "p", lambda a: False, "again", default="none") == "none"


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stream_windows_of_odd_times(spark, tmp_path, zone, kind):
    """Next to the SQL: zones that skip and repeat an hour, the last half millisecond of an hour, times before 1970, rows without a time, a type or a value."""
    import duckdb

    from tracklode import queries as own

    times = ["2024-03-10 02:30:00", "2024-11-03 01:30:00.5", "2024-11-03 02:00:00", "2024-01-01 00:59:59.9995", "2024-01-01 00:59:59.999499", "1970-01-01 00:59:59.999999", "1970-01-01 00:00:00"]
    times += ["1969-12-31 23:59:59.999999", "1969-12-31 23:00:00.0005", "1969-12-31 23:00:00.000501", "1969-12-31 22:59:59.9999", "1969-12-31 22:00:00", "1850-05-05 05:05:05.000005", None]
    rows = [(i, t, None if i % 7 == 3 else "ab"[i % 2], None if i % 5 == 1 else i / 4) for i, t in enumerate(times * 4)]
    df = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast(kind))
    df.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = [tuple(r) for r in own.queries()["stream_windows"](spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(got, key=str) == sorted(con.execute(own.oracle_sql()["stream_windows"]).fetchall(), key=str)
