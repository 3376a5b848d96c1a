"""Registered queries over sources, sinks, clips and the smaller helpers, with their SQL. Files go to the shared folder and are read back.

Stand-in columns are made by expressions that both engines read alike, as in ``queries``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklode.functions import clips, expr, models, vision
from tracklode.functions import text as X
from tracklode.functions.expr import rounded
from tracklode.operators import aggregates as A
from tracklode.operators import episodes as E
from tracklode.operators import manifest as M
from tracklode.operators import qc as Q
from tracklode.operators import sampling as S
from tracklode.operators import trajectory as W
from tracklode.plans import jobs as P
from tracklode.queries import derived, query, table
from tracklode.sources import readers as R
from tracklode.sources import sinks as K
from tracklode.sources.scratch import Scratch, scratch_path

# ---- tables in files ------------------------------------------------------------------------------------


@query("SELECT event_id::VARCHAR AS event_id, props, coalesce(event_type, '') AS event_type, '' AS missing FROM events")
def csv_round_trip(spark, sf_dir):
    """Quotes and commas inside fields, a column that is not there, one that is left out."""
    path = scratch_path(spark, "csv")
    K.write_csv(table(spark, sf_dir, "events"), path, ["event_id", "props", "event_type", "missing"])
    return R.read_csv(spark, path, multi_line=False)


@query("SELECT p_partkey::VARCHAR AS id, p_name AS name, '' AS extra FROM part UNION ALL SELECT s_suppkey::VARCHAR, '', s_name FROM supplier")
def csv_union_columns(spark, sf_dir):
    """K2: all columns in the order first seen, '' where a table lacks one."""
    path = scratch_path(spark, "union")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    K.write_union_csv([parts, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("extra"))], path)
    return R.read_csv(spark, path)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def jsonl_append(spark, sf_dir):
    """One part written, the rest appended, read back by schema."""
    path, rows = scratch_path(spark, "jsonl"), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    K.write_jsonl(rows.where("o_orderkey % 2 = 0"), path)
    K.append_jsonl(rows.where("o_orderkey % 2 <> 0"), path)
    return R.read_jsonl(spark, path, rows.schema)


@query("""SELECT 'parquet' AS kind, count(*) AS n, min(n_name) AS first FROM nation UNION ALL SELECT 'sibling', count(*), min(r_name) FROM region UNION ALL SELECT 'pointer', count(*), min(s_name) FROM supplier
UNION ALL SELECT 'none', 0, NULL UNION ALL SELECT 'sidecar', count(*), min(n_name) FROM nation""")
def table_fallbacks(spark, sf_dir):
    """Parquet, the CSV next to it, the one a pointer names, nothing, and a table that Parquet cannot hold."""
    root = scratch_path(spark, "tables")
    names = {"parquet": ("nation", "n_name"), "sibling": ("region", "r_name"), "pointer": ("supplier", "s_name")}
    rows = {k: table(spark, sf_dir, t).select(F.col(c).alias("name")) for k, (t, c) in names.items()}
    K.write_table(rows["parquet"], f"{root}/a.parquet")
    K.write_csv(rows["sibling"], f"{root}/b.csv")
    K.write_csv(rows["pointer"], f"{root}/elsewhere.csv")
    K.write_json(spark, f"{root}/c.fallback.json", {"path": f"{root}/elsewhere.csv"})
    K.write_table(rows["parquet"].withColumn("gap", F.expr("make_interval(0, 1)")), f"{root}/e.parquet")
    got = [("parquet", "a"), ("sibling", "b"), ("pointer", "c"), ("none", "d"), ("sidecar", "e")]
    one = lambda kind, name: R.read_table(spark, f"{root}/{name}.parquet", "name string").agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.min("name").alias("first"))
    out = one(*got[0])
    for kind, name in got[1:]:
        out = out.unionAll(one(kind, name))
    return out


@query("SELECT 'csv' AS kind, count(*) AS n FROM nation UNION ALL SELECT 'parquet', count(*) FROM region UNION ALL SELECT 'missing', -1")
def required_tables(spark, sf_dir):
    """A table that has to be there, of either kind, and what happens if it is not."""
    root = scratch_path(spark, "required")
    K.write_csv(table(spark, sf_dir, "nation"), f"{root}/a.csv")
    K.write_table(table(spark, sf_dir, "region"), f"{root}/b.parquet")
    counts = [("csv", R.read_required(spark, f"{root}/a.csv").count()), ("parquet", R.read_required(spark, f"{root}/b.parquet").count())]
    try:
        R.read_required(spark, f"{root}/c.parquet")
    except FileNotFoundError:
        counts.append(("missing", -1))
    return spark.createDataFrame(counts, "kind string, n long")


@query("SELECT k.kind, r_name AS name, r_regionkey::BIGINT AS value FROM region, (VALUES ('json'), ('yaml')) k(kind) UNION ALL SELECT 'default', 'none', 0")
def small_documents(spark, sf_dir):
    """Settings written and read as JSON and YAML; a document that is not there gives the default."""
    root = scratch_path(spark, "documents")
    value = {"regions": [{"name": r.r_name, "value": r.r_regionkey} for r in table(spark, sf_dir, "region").collect()], "empty": [], "text": 'a "b": c\n# d'}
    K.write_json(spark, f"{root}/a.json", value)
    K.write_yaml(spark, f"{root}/a.yaml", value)
    read = {"json": R.read_json(spark, f"{root}/a.json"), "yaml": R.read_yaml(spark, f"{root}/a.yaml")}
    if any(v != value for v in read.values()):
        raise ValueError("the documents differ from what was written")
    rows = [(kind, r["name"], r["value"]) for kind, v in read.items() for r in v["regions"]]
    return spark.createDataFrame([*rows, ("default", "none", R.read_json(spark, f"{root}/b.json", 0))], "kind string, name string, value long")


@query("SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus")
def status_folders(spark, sf_dir):
    """K8: a folder a status, read back as a column."""
    path = scratch_path(spark, "status")
    K.write_by_status(table(spark, sf_dir, "orders"), path, "o_orderstatus")
    return spark.read.parquet(path).groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT 'accepted' AS kind, c_custkey, NULL AS reason FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT 'rejected', c_custkey, 'in debt' FROM customer WHERE c_acctbal < 0""")
def accepted_and_rejected(spark, sf_dir):
    """K9: two outputs, the rejects with their reasons."""
    path = scratch_path(spark, "rejects")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, "in debt").alias("reason"))
    K.write_accepted_and_rejected(rows, path, "reason")
    good, bad = (spark.read.parquet(f"{path}/{k}") for k in ("accepted", "rejected"))
    return good.select(F.lit("accepted").alias("kind"), "c_custkey", F.lit(None).cast("string").alias("reason")).unionAll(bad.select(F.lit("rejected"), "c_custkey", "reason"))


@query("SELECT 'regions.jsonl' AS name, count(*) AS n FROM region UNION ALL SELECT 'nations.jsonl', count(*) FROM nation")
def archived_manifests(spark, sf_dir):
    """Small manifests in one archive; members and lines as any reader sees them."""
    import io
    import tarfile

    path = scratch_path(spark, "archive") + ".tar.gz"
    K.archive(spark, {"regions.jsonl": table(spark, sf_dir, "region"), "nations.jsonl": table(spark, sf_dir, "nation")}, path)
    data = spark.read.format("binaryFile").load(path).select("content").first()[0]
    with tarfile.open(fileobj=io.BytesIO(bytes(data))) as tar:
        rows = [(m.name, len(tar.extractfile(m).read().splitlines())) for m in tar.getmembers()]
    return spark.createDataFrame(rows, "name string, n long")


@query("SELECT 'Counts' AS section, r_name AS first, r_regionkey::VARCHAR AS second FROM region UNION ALL SELECT 'Text', 'All is well.', ''")
def markdown_report(spark, sf_dir):
    """A report written, and its tables read back."""
    path, out, section = scratch_path(spark, "report") + ".md", [], ""
    K.write_text(spark, path, K.report("Regions", {"Counts": table(spark, sf_dir, "region").select("r_name", "r_regionkey"), "Text": "All is well."}))
    for line in spark.read.text(path, wholetext=True).first()[0].splitlines():
        if line.startswith("## "):
            section = line[3:]
        elif line.startswith("| ") and not line.startswith(("| r_name", "| - ")):
            out.append((section, *(x.strip() for x in line.strip("|").split("|"))))
        elif line and not line.startswith(("#", "|")):
            out.append((section, line, ""))
    return spark.createDataFrame(out, "section string, first string, second string")


@query("SELECT doc_id, quality::VARCHAR AS human_label, NULL::BIGINT AS versions FROM labels WHERE doc_id IS NOT NULL UNION ALL SELECT -1, 'versions', 2")
def saved_labels(spark, sf_dir):
    """Every save is a new version next to the old; the last is what counts."""
    path, rows = scratch_path(spark, "labels"), table(spark, sf_dir, "labels").where("doc_id is not null").select("doc_id", F.col("quality").cast("string").alias("human_label"))
    K.save_labels(rows.limit(5), path, 19)
    last = K.save_labels(rows, path, 20)
    kept = R.listing(spark, path, "*.parquet").select(F.regexp_extract("path", r"/((?:labels|backup)-\d+)/", 1).alias("v")).distinct().count()
    more = spark.createDataFrame([(-1, "versions", kept)], "doc_id long, human_label string, versions long")
    return spark.read.parquet(last).select("doc_id", "human_label", F.lit(None).cast("long").alias("versions")).unionAll(more)


# ---- files ----------------------------------------------------------------------------------------------


@query("""SELECT * FROM (VALUES ('val', 'split', 2), ('test', 'split', 2), ('val_videos_1', 'video', 1), ('test/clips/videos', 'nested', 1)) v(dataset, kind, files)""")
def discovered_datasets(spark, sf_dir):
    """Split folders, video folders, and video folders further down, from a listing of names."""
    root = scratch_path(spark, "root")
    names = ["val/data/episode1.json", "val/data/episode2.json", "test/data/episode1.json", "test/clips/videos/episode1.mp4", "val_videos_1/episode1.mp4", "readme.json"]
    for n in names:
        K.write_text(spark, f"{root}/{n}", "{}")
    return R.datasets(R.listing(spark, root), root)


@query("SELECT DISTINCT replace(p_name, ' ', '_') AS task FROM part")
def task_catalogue(spark, sf_dir):
    """Tasks that have code or settings, each once; private ones are left out."""
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    files = table(spark, sf_dir, "part").select(F.explode(F.array(F.concat(F.lit("envs/"), name, F.lit(".py")), F.concat(F.lit("code_gen/"), name, F.lit(".json")), F.concat(F.lit("envs/_"), name, F.lit(".py")))).alias("path"))
    return R.tasks(files)


@query("SELECT user_id % 7 AS job_id, count(*) FILTER (WHERE event_id % 3 = 0) AS done FROM events GROUP BY 1 HAVING count(*) FILTER (WHERE event_id % 3 = 0) > 0")
def done_counts(spark, sf_dir):
    """Episode files of each job."""
    path = F.concat(F.lit("out/episode"), F.col("event_id").cast("string"), F.when(F.col("event_id") % 3 == 0, ".hdf5").otherwise(".mp4"))
    return P.done_counts(table(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("job_id"), path.alias("path")))


@query("SELECT n_regionkey AS shape, count(*) AS n, count(*) FILTER (WHERE n_nationkey % 2 = 0) AS exportable, min(n_name) AS first_frame FROM nation GROUP BY n_regionkey")
def probe_outputs(spark, sf_dir):
    """Trial runs by shape, with the first one's frame."""
    rows = table(spark, sf_dir, "nation").withColumn("ok", F.col("n_nationkey") % 2 == 0)
    return P.probe_summary(rows.withColumnRenamed("n_regionkey", "shape"), "shape", "ok", "n_name")


@query("""WITH e AS (SELECT label, embedding, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1)::INT AS t FROM embeddings WHERE label IS NOT NULL)
SELECT label, t, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 5) AS total, len(embedding)::INT AS width, 0::BIGINT AS rejects FROM e UNION ALL SELECT -1, 0, 0, 0, 1""")
def npy_round_trip(spark, sf_dir):
    """An array file for each key, written from executors and decoded again; a broken one is rejected with its error."""
    root, rows = scratch_path(spark, "npy"), table(spark, sf_dir, "embeddings").where("label is not null")
    made = K.npy_bytes(rows, ["label"], ["vec_id"], "embedding").withColumn("name", F.concat(F.col("label").cast("string"), F.lit(".npy")))
    bad = spark.createDataFrame([("bad.npy", bytearray(b"no array"))], "name string, content binary")
    K.write_files(made.select("name", "content").unionAll(bad), root, "name", "content").count()
    files = spark.read.format("binaryFile").load(root).select("path", "content")
    form = "path string, t int, joint array<double>"
    back = R.decode_files(files, R.decode_npy, form).withColumn("label", F.regexp_extract("path", r"/(\d+)\.npy$", 1).cast("int"))
    total = F.aggregate("joint", F.lit(0.0), lambda s, x: s + x)
    out = back.select("label", "t", F.round(total, 5).alias("total"), F.size("joint").alias("width"), F.lit(0).cast("long").alias("rejects"))
    return out.unionAll(R.rejected_files(files, R.decode_npy, form).agg(F.lit(-1), F.lit(0), F.lit(0.0), F.lit(0), F.count("*")))


def _bmp(height: int, width: int):
    """A picture of 24 bits a pixel from blue, green and red bytes, rows from below and filled to four bytes."""

    @F.pandas_udf("binary")
    def made(pixels):
        import struct

        pad = -width * 3 % 4
        size = (width * 3 + pad) * height
        head = struct.pack("<2sIHHI", b"BM", 54 + size, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, size, 2835, 2835, 0, 0)
        rows = lambda p: np.pad(np.frombuffer(p, np.uint8).reshape(height, width * 3)[::-1], ((0, 0), (0, pad))).tobytes()
        return pixels.map(lambda p: head + rows(p))

    return made


GRAY = "CAST(floor((x + 1) * 127) AS INT)"


@query(f"""WITH g AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: {GRAY}) AS g FROM embeddings WHERE vec_id % 5 = 0), s AS (SELECT vec_id, g, list_avg(g) AS m FROM g)
SELECT vec_id, 8 AS height, 8 AS width, round(m, 4) AS brightness, round(sqrt(list_avg(list_transform(g, lambda x: (x - m) * (x - m)))), 4) AS contrast, round(m, 4) AS mean_r, 0.0::DOUBLE AS saturation FROM s""")
def picture_stats(spark, sf_dir):
    """S13, X32, K: pictures written from executors, read by the engine's own reader, and their statistics."""
    root = scratch_path(spark, "pictures")
    rows = table(spark, sf_dir, "embeddings").where("vec_id % 5 = 0")
    gray = F.transform("embedding", lambda x: F.lpad(F.hex(F.floor((x.cast("double") + 1) * 127).cast("int")), 2, "0"))
    pixels = F.unhex(F.array_join(F.transform(gray, lambda x: F.concat(x, x, x)), ""))
    made = rows.select(F.concat(F.col("vec_id").cast("string"), F.lit(".bmp")).alias("name"), _bmp(8, 8)(pixels).alias("content"))
    K.write_files(made, root, "name", "content").count()
    read = R.read_images(spark, root).withColumn("stats", vision.image_stats_udf("height", "width", "pixels"))
    vec = F.regexp_extract("path", r"/(\d+)\.bmp$", 1).cast("long").alias("vec_id")
    return read.select(vec, "height", "width", *(F.round(f"stats.{c}", 4).alias(c) for c in ("brightness", "contrast", "mean_r", "saturation")))


# ---- clips ----------------------------------------------------------------------------------------------


def _clip_frames(spark: SparkSession) -> DataFrame:
    """Two synthetic clips: a dark foreground that comes in, and a jump of exposure."""

    def box(img, x0, y0, x1, y1, color):
        img[max(0, y0) : y1 + 1, max(0, x0) : max(0, x1 + 1)] = color

    rows = []
    for k in range(24):
        enter, jump = np.full((120, 160, 3), 235, np.uint8), np.full((120, 160, 3), 210 if k < 12 else 245, np.uint8)
        for args in ((20, 70, 145, 88, 238), (-85 + 11 * k, 20, 3 + 11 * k, 112, 20), (90, 78, 125, 86, (45, 140, 230))):
            box(enter, *args)
        for args in ((25, 40, 70, 90, 35), (95, 78, 128, 86, (40, 130, 220))):
            box(jump, *args)
        rows += [("enter", k, 120, 160, bytearray(enter.tobytes())), ("jump", k, 120, 160, bytearray(jump.tobytes()))]
    return spark.createDataFrame(rows, "path string, frame_idx int, height int, width int, pixels binary")


@query("""SELECT * FROM (VALUES ('enter', 24, true, true, true, false, '', 'pass'), ('jump', 24, true, true, false, true, 'background_flicker_candidate', 'warn')) v(path, frames, rgb_over_15, luma_over_3, flicker_under_6, flicker, labels, status)""")
def clip_rule_check(spark, sf_dir):
    """Masks and metrics of stored frames, fed to the rule check; the two clips differ in what moves."""
    made = clips.rule_columns(clips.clip_metrics(_clip_frames(spark)))
    rest = {"read_fails": F.lit(0), "bad_ratio": F.lit(0.0), "width": F.lit(640), "height": F.lit(480), "fps": F.lit(24.0), "action_ok": F.lit(True), "has_nan": F.lit(False), "has_inf": F.lit(False), "blockiness": F.lit(0.0), "sharpness": F.lit(99.0), "dpo_score": F.lit(0.0)}
    out = Q.rule_check(made.withColumns(rest))
    return out.select("path", F.col("frames").cast("int").alias("frames"), (F.col("rgb_step") > 15).alias("rgb_over_15"), (F.col("luma_step") > 3).alias("luma_over_3"), (F.col("bg_luma") < 6).alias("flicker_under_6"), F.col("background_flicker").alias("flicker"), F.col("qc_labels").alias("labels"), F.col("qc_status").alias("status"))


@query("SELECT * FROM (VALUES ('still', true, false, 0.0::DOUBLE), ('slide', false, false, 1.0::DOUBLE)) v(path, static_clip, over_motion_clip, motion_active_ratio)")
def clip_flow(spark, sf_dir):
    """Optical flow of a still clip and of one that slides two pixels a frame."""
    field = clips.box(np.random.default_rng(0).uniform(0, 255, (80, 120)), 7)
    field = np.rint((field - field.min()) / (field.max() - field.min()) * 255).astype(np.uint8)
    cut = lambda k, step: bytearray(np.repeat(field[8:72, 8 + step * k : 104 + step * k, None], 3, axis=2).tobytes())
    rows = [(name, k, 64, 96, cut(k, step)) for name, step in (("still", 0), ("slide", 2)) for k in range(5)]
    frames = spark.createDataFrame(rows, "path string, frame_idx int, height int, width int, pixels binary")
    return clips.flow_metrics(frames).select("path", "static_clip", "over_motion_clip", "motion_active_ratio")


@query("""SELECT vec_id, CASE WHEN e[1] > 0.94 AND abs(e[2]) < 0.025 THEN 'FAIL_white' WHEN e[1] < 0.05 THEN 'FAIL_dark' WHEN abs(e[3]) < 0.01 THEN 'FAIL_empty' ELSE 'OK' END AS sanity FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)""")
def visual_sanity(spark, sf_dir):
    """X37."""
    e = lambda i: F.col("embedding")[i].cast("double")
    return table(spark, sf_dir, "embeddings").select("vec_id", vision.visual_sanity(e(0), F.abs(e(1)), F.abs(e(2))).alias("sanity"))


@query("""WITH w AS (SELECT doc_id, [length(text)::DOUBLE, (length(text) - length(replace(text, 'e', '')))::DOUBLE, 1.0::DOUBLE] AS v FROM documents WHERE text IS NOT NULL)
SELECT doc_id, round(v[1] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 4) AS first, round(v[3] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 4) AS last FROM w""")
def model_embeddings(spark, sf_dir):
    """The batch hook with a stand-in for a model, brought to unit length."""

    def load():
        return lambda texts: np.array([[len(t), t.count("e"), 1.0] for t in texts], dtype=np.float32)

    rows = models.with_embedding(table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text"), "text", load)
    return rows.select("doc_id", F.round(F.col("embedding")[0], 4).alias("first"), F.round(F.col("embedding")[2], 4).alias("last"))


@query("""WITH e AS (SELECT label, vec_id, embedding::DOUBLE[] AS a, list_slice(embedding::DOUBLE[], 1, 32) AS b FROM embeddings), p AS (SELECT *, lag(a) OVER w AS pa, lag(b) OVER w AS pb FROM e WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
c AS (SELECT label, list_cosine_similarity(a, pa) AS ca, list_cosine_similarity(b, pb) AS cb FROM p), m AS (SELECT *, 0.65 * ca + 0.35 * cb AS k FROM c)
SELECT label, round(avg(k), 6) AS blend_mean, round(min(k), 6) AS blend_min, round(min(ca), 6) AS first_min, round(min(cb), 6) AS second_min, round(1 - min(k), 6) AS scene_cut FROM m GROUP BY label""")
def blended_similarity(spark, sf_dir):
    """Two kinds of vectors, blended."""
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.col("embedding").alias("a"), F.slice("embedding", 1, 32).alias("b"))
    return W.blended_similarity(e, ["label"], ["vec_id"], "a", "b")


@query("SELECT * FROM (VALUES ('enter', 160, 120, 24::BIGINT, 2.3::DOUBLE, true, 2::BIGINT), ('jump', 160, 120, 24, 2.3, true, 0)) v(path, width, height, frames, duration, readable, read_fails)")
def video_figures(spark, sf_dir):
    """Sizes and failed reads of decoded frames."""
    frames = _clip_frames(spark).withColumn("seconds", F.col("frame_idx") / 10)
    lost = frames.withColumn("pixels", F.when((F.col("path") != "enter") | (F.col("frame_idx") > 1), F.col("pixels")))
    return R.video_meta(frames).join(R.read_fails(lost).drop("frames"), "path").select("path", "width", "height", "frames", "duration", "readable", "read_fails")


@query("SELECT w AS token, count(*) AS n FROM (SELECT unnest(string_split(p_type, ' ')) AS w FROM part) GROUP BY w ORDER BY n DESC, w LIMIT 8")
def array_counts(spark, sf_dir):
    """A3 over arrays."""
    return A.array_counts(table(spark, sf_dir, "part").select(F.split("p_type", " ").alias("w")), "w", top=8)


@query("SELECT o_custkey, arg_min(o_orderkey, {'d': o_orderdate, 'k': o_orderkey}) AS o_orderkey FROM orders GROUP BY o_custkey")
def first_orders(spark, sf_dir):
    """The first row of each key."""
    return S.keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT user_id, round(max(value), 6) AS top, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY user_id")
def robust_maxima(spark, sf_dir):
    """A29."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(rounded(A.robust_max("value")).alias("top"), rounded(A.robust_max("value", 0.9)).alias("p90"))


# ---- episodes -------------------------------------------------------------------------------------------

PARTS = {"joint": (1, 14), "left_pose": (15, 7), "right_pose": (22, 7)}


def _episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").where("label is not null")
    parts = {n: F.transform(F.slice("embedding", a, k), lambda x: x.cast("double")) for n, (a, k) in PARTS.items()}
    return e.select("label", "vec_id", *(c.alias(n) for n, c in parts.items()), *(F.col("embedding")[i].cast("double").alias(n) for n, i in (("left_grip", 6), ("right_grip", 13))))


def _episodes_sql() -> str:
    cut = lambda a, k: f"list_slice(e, {a}, {a + k - 1})"
    norm = lambda n: f"sqrt(list_sum(list_transform(list_slice({n}_pose, 4, 7), lambda x: x * x)))"
    both = lambda f: ", ".join(f.replace("{s}", s) for s in ("left", "right"))
    thr = "CASE WHEN count(DISTINCT round({s}_grip, 6)) <= 8 THEN (min(round({s}_grip, 6)) + max(round({s}_grip, 6))) / 2 ELSE (quantile_cont({s}_grip, 0.05) + quantile_cont({s}_grip, 0.95)) / 2 END AS {s}_thr"
    grip = "min({s}_grip) AS {s}_gripper_min, max({s}_grip) AS {s}_gripper_max, avg({s}_grip) AS {s}_gripper_mean, stddev_pop({s}_grip) AS {s}_gripper_std, count(*) FILTER (WHERE {s}_switch) AS {s}_gripper_transition_count"
    quat = "avg({s}_norm) AS {s}_quat_norm_mean, stddev_pop({s}_norm) AS {s}_quat_norm_std, max(abs({s}_norm - 1)) AS {s}_quat_norm_max_abs_dev, avg((abs({s}_norm - 1) <= 0.05)::INT) AS {s}_quat_norm_close_ratio"
    arm = "coalesce(sum({s}_delta), 0) AS {s}_arm_motion_l2_sum, coalesce(avg(({s}_delta > active_thr)::INT), 0) AS {s}_arm_active_ratio"
    return f"""e0 AS (SELECT label, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL),
e1 AS (SELECT label, vec_id, {', '.join(f'{cut(a, k)} AS {n}' for n, (a, k) in PARTS.items())}, e[7] AS left_grip, e[14] AS right_grip FROM e0),
d AS (SELECT *, list_distance(joint, lag(joint) OVER w) AS delta, list_distance(joint[1:6], lag(joint[1:6]) OVER w) AS left_delta, list_distance(joint[8:13], lag(joint[8:13]) OVER w) AS right_delta, {norm('left')} AS left_norm, {norm('right')} AS right_norm
  FROM e1 WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
lim AS (SELECT quantile_cont(delta, 0.10) AS pause_thr, quantile_cont(delta, 0.25) AS active_thr, quantile_cont(delta, 0.99) AS spike_thr, quantile_cont(delta, 0.95) AS p95_ref, avg(delta) AS mean_ref, {both(thr)} FROM d),
f AS (SELECT *, delta > pause_thr AS active, left_grip > left_thr AS left_up, right_grip > right_thr AS right_up FROM d, lim),
g AS (SELECT *, coalesce(active, false) AND NOT coalesce(lag(active) OVER w, false) AS edge, {both('coalesce({s}_up <> lag({s}_up) OVER w, false) AS {s}_switch')} FROM f WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
s AS (SELECT label, count(*) AS T, max(len(joint))::INT AS action_dim, false AS has_nan, false AS has_inf, min(list_min(joint)) AS joint_action_min, max(list_max(joint)) AS joint_action_max, avg(sqrt(list_sum(list_transform(joint, lambda x: x * x)))) AS joint_action_mean_l2,
  avg(delta) AS joint_delta_mean_l2, max(delta) AS joint_delta_max_l2, quantile_cont(delta, 0.95) AS joint_delta_p95_l2, {both(arm)}, coalesce(avg((left_delta > active_thr AND right_delta > active_thr)::INT), 0) AS bimanual_active_ratio, {both(grip)}, {both(quat)},
  coalesce(avg((delta <= pause_thr)::INT), 0) AS pause_ratio, coalesce(avg((delta >= spike_thr)::INT), 0) AS spike_ratio, count(*) FILTER (WHERE edge) AS estimated_motion_segments, any_value(mean_ref) AS mean_ref, any_value(p95_ref) AS p95_ref,
  min(delta) AS delta_l2_min, stddev_pop(delta) AS delta_l2_std, quantile_cont(delta, 0.5) AS delta_l2_p50, quantile_cont(delta, 0.9) AS delta_l2_p90, quantile_cont(delta, 0.99) AS delta_l2_p99,
  count(*) FILTER (WHERE delta <= pause_thr) AS pause_transition_count, count(*) FILTER (WHERE delta >= spike_thr) AS spike_transition_count FROM g GROUP BY label),
wide AS (SELECT *, greatest(T - 1, 0) AS transition_count, joint_delta_mean_l2 AS delta_l2_mean, joint_delta_max_l2 AS delta_l2_max, joint_delta_p95_l2 AS delta_l2_p95,
  CASE WHEN left_arm_motion_l2_sum > right_arm_motion_l2_sum * 1.15 THEN 'left' WHEN right_arm_motion_l2_sum > left_arm_motion_l2_sum * 1.15 THEN 'right' ELSE 'balanced' END AS dominant_arm,
  least(CASE WHEN joint_delta_mean_l2 IS NULL THEN 0 ELSE least(joint_delta_mean_l2 / greatest(mean_ref, 1e-9), 3.0) + least(joint_delta_p95_l2 / greatest(p95_ref, 1e-9), 3.0) END + bimanual_active_ratio * 1.5
    + least((left_gripper_transition_count + right_gripper_transition_count) / 6.0, 1.5) + least(estimated_motion_segments / 8.0, 1.0), 10.0) AS action_complexity_score FROM s)"""


def _shown(names: list[str]) -> str:
    plain = {"T", "action_dim", "has_nan", "has_inf", "dominant_arm", "transition_count", "estimated_motion_segments"}
    return ", ".join(n if n in plain or n.endswith("_count") else f"round({n}, 6) AS {n}" for n in names)


@query(f"WITH {_episodes_sql()} SELECT label, {_shown(E.EPISODE_COLUMNS)} FROM wide")
def action_stats_episode(spark, sf_dir):
    """The whole table of an episode's actions."""
    return E.episode_table(E.full_stats(_episodes(spark, sf_dir), ["label"], ["vec_id"]), ["label"])


@query(f"WITH {_episodes_sql()} SELECT label, {_shown(E.TRANSITION_COLUMNS)} FROM wide")
def action_transition_stats(spark, sf_dir):
    """The whole table of an episode's steps."""
    return E.transition_table(E.full_stats(_episodes(spark, sf_dir), ["label"], ["vec_id"]), ["label"])


@query(f"""WITH {_episodes_sql()}, r AS (SELECT label, {_shown(list(dict.fromkeys([*E.EPISODE_COLUMNS, *E.TRANSITION_COLUMNS])))} FROM wide),
o AS (SELECT quantile_cont(T, 0.99) AS tl, quantile_cont(joint_delta_max_l2, 0.99) AS dl, quantile_cont(action_complexity_score, 0.99) AS cl FROM r),
w AS (SELECT r.*, concat_ws(';', CASE WHEN T >= tl THEN 'trajectory_length_p99' END, CASE WHEN joint_delta_max_l2 >= dl THEN 'delta_max_p99' END, CASE WHEN action_complexity_score >= cl THEN 'complexity_p99' END,
  CASE WHEN left_quat_norm_max_abs_dev > 0.1 THEN 'left_quat_norm_max_abs_dev>0.1' END, CASE WHEN right_quat_norm_max_abs_dev > 0.1 THEN 'right_quat_norm_max_abs_dev>0.1' END) AS reason FROM r, o)
SELECT label, reason, T, joint_delta_max_l2, spike_ratio, action_complexity_score, left_quat_norm_max_abs_dev, right_quat_norm_max_abs_dev FROM w WHERE reason <> ''""")
def action_outlier_episodes(spark, sf_dir):
    """A15."""
    full = Scratch(spark).write(E.full_stats(_episodes(spark, sf_dir), ["label"], ["vec_id"]), "episodes")
    return E.outlier_table(full, ["label"])


@query(f"""WITH {_episodes_sql()}, m AS (SELECT least(avg(round(left_quat_norm_close_ratio, 6)), avg(round(right_quat_norm_close_ratio, 6))) AS c, avg(round(action_complexity_score, 6)) AS k FROM wide)
SELECT CASE WHEN k >= 4 THEN 'joint14+ee16' ELSE 'joint14' END AS recommended_primary, concat_ws(' ', CASE WHEN c >= 0.98 THEN '{E.ADVICE['close']}' ELSE '{E.ADVICE['apart']}' END, CASE WHEN k >= 4 THEN '{E.ADVICE['moving']}' ELSE '{E.ADVICE['plain']}' END, '{E.ADVICE['last']}') AS recommendation FROM m""")
def representation_advice(spark, sf_dir):
    """D-9."""
    return E.recommendation(E.full_stats(_episodes(spark, sf_dir), ["label"], ["vec_id"]))


@query("""WITH n AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), r AS (SELECT label, count(*) AS n FROM n GROUP BY label)
SELECT label, CASE WHEN label = 0 THEN 'action_missing' ELSE concat_ws(';', CASE WHEN label % 3 = 1 THEN 'action_shape_invalid' END, CASE WHEN label % 4 = 2 THEN 'missing_left_gripper' END, CASE WHEN n < 60 THEN 'too_short' END, CASE WHEN label % 5 = 3 THEN 'pose_length_mismatch' END) END AS reason FROM r""")
def action_contract(spark, sf_dir):
    """Shape, missing series, length, and poses of another length, by typed reasons."""
    width = F.when(F.col("label") % 3 == 1, 13).otherwise(14)
    steps = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.collect_list(F.slice(F.transform("embedding", lambda x: x.cast("double")), F.lit(1), width)).alias("v"))
    values = F.when(F.col("label") != 0, F.col("v"))
    pose = F.when(F.col("label") % 5 == 3, F.slice("v", 1, 1)).otherwise(F.col("v"))
    needed = {"left_gripper": F.when(F.col("label") % 4 != 2, F.lit(1)), "right_gripper": F.lit(1)}
    return steps.select("label", W.contract_reasons(values, needed=needed, poses=(pose,)).alias("reason"))


# ---- helpers --------------------------------------------------------------------------------------------


@query("""SELECT c_custkey, '/data/' || c_name AS absolute, 'sub/' || c_name AS relative, CASE WHEN c_custkey % 2 = 0 THEN 'val' ELSE 'test' END AS split,
  CASE c_custkey % 3 WHEN 1 THEN 'variant_1' WHEN 2 THEN 'variant_2' ELSE 'base' END AS prompt_set, '/ref/' || CASE WHEN c_custkey % 2 = 0 THEN 'val' ELSE 'test' END || '/first_frame/fixed_scene_task/episode' || c_custkey::VARCHAR || '.png' AS frame,
  'clean__ur5' AS base, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS name FROM customer""")
def path_helpers(spark, sf_dir):
    """H2, H3, H4, H13, X18, X20."""
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    name = F.concat(F.when(key % 2 == 0, "val").otherwise("test"), F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("_"), (key % 3).cast("string"))))
    split, prompts = expr.set_split(name)
    path = F.when(key % 2 == 0, F.concat(F.lit("/data/"), "c_name")).otherwise(F.col("c_name"))
    maybe = F.when(key % 5 == 0, F.when(key % 2 == 0, "nan")).otherwise(F.col("c_name"))
    return c.select(
        "c_custkey", expr.absolute_path("/data", path).alias("absolute"), expr.relative_path(F.concat(F.lit("/data/sub/"), "c_name"), "/data").alias("relative"), split.alias("split"), prompts.alias("prompt_set"),
        M.reference_frame_path("/ref", split, key).alias("frame"), expr.base_name(F.concat(F.lit("clean__ur5__job_"), key.cast("string"))).alias("base"), expr.text_of(maybe).alias("name"),
    )


@query("""WITH s AS (SELECT o_orderkey, (o_orderkey * 37 % 100000)::BIGINT AS s, o_orderkey % 11 AS d FROM orders)
SELECT o_orderkey, printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) AS clock, '[' || repeat('#', floor(d / 10 * 20)::INT) || repeat('-', 20 - floor(least(d / 10, 1) * 20)::INT) || ']' AS bar FROM s WHERE d <= 10""")
def clocks_and_bars(spark, sf_dir):
    """X21."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    return o.select("o_orderkey", expr.clock(key * 37 % 100000).alias("clock"), expr.bar(key % 11, F.lit(10), 20).alias("bar"))


@query("""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
SELECT vec_id, len(e[15:21]) + 1 + len(e[22:28]) + 1 AS width, round(list_sum(e[15:28]) + e[7] + e[14], 5) AS total, round(sqrt(e[1] * e[1] + 10000 * e[2] * e[2] + e[3] * e[3]), 5) AS distance,
  vec_id % 13 > 0 AND (vec_id % 17) / (vec_id % 13) BETWEEN 0.1 AND 10 AS length_ok FROM e""")
def vector_helpers(spark, sf_dir):
    """X29, X31, X43."""
    e = _episodes(spark, sf_dir).join(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id")
    v = expr.ee16("left_pose", "left_grip", "right_pose", "right_grip")
    x = [F.col("embedding")[i].cast("double") for i in range(3)]
    return e.select("vec_id", F.size(v).alias("width"), F.round(F.aggregate(v, F.lit(0.0), lambda s, y: s + y), 5).alias("total"), F.round(expr.feature_distance(*x), 5).alias("distance"), expr.length_ratio_ok(F.col("vec_id") % 17, F.col("vec_id") % 13).alias("length_ok"))


@query("""WITH c AS (SELECT p_partkey, p_size AS n FROM part), i AS (SELECT p_partkey, n, unnest(range(0, 8)) AS i FROM c),
s AS (SELECT p_partkey, list(DISTINCT round_even(i * (n - 1) / 7.0, 0)::BIGINT) AS l FROM i WHERE n > 8 GROUP BY p_partkey)
SELECT c.p_partkey, CASE WHEN n <= 0 THEN 0 WHEN n <= 8 THEN n ELSE len(l) END::INT AS n_frames, CASE WHEN n <= 0 THEN 0 WHEN n <= 8 THEN n * (n - 1) // 2 ELSE list_sum(l) END::BIGINT AS total, round_even(3 / greatest(n - 1, 1) * 99, 0)::INT AS peak FROM c LEFT JOIN s ON c.p_partkey = s.p_partkey""")
def frame_choices(spark, sf_dir):
    """Frames spread evenly, and the frame a step falls on."""
    part = table(spark, sf_dir, "part")
    picked = part.select("p_partkey", expr.even_indices("p_size", 8).alias("l"), W.peak_frames(F.lit(3), "p_size", F.lit(100)).alias("peak"))
    return picked.select("p_partkey", F.size("l").alias("n_frames"), F.aggregate("l", F.lit(0).cast("long"), lambda s, x: s + x).alias("total"), "peak")


@query("""SELECT p_partkey, concat_ws(';', CASE WHEN p_size > 40 THEN 'size' END, CASE WHEN p_partkey % 600 NOT BETWEEN 1 AND 512 THEN 'spp' END, CASE WHEN p_size NOT BETWEEN 1 AND 32 THEN 'depth' END, CASE WHEN p_partkey % 4 = 3 THEN 'denoiser' END) AS faults FROM part""")
def config_faults(spark, sf_dir):
    """F15."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("size"), (F.col("p_partkey") % 600).alias("spp"), F.col("p_size").alias("depth"), F.expr("element_at(array('OIDN', 'none', '', 'other'), cast(p_partkey % 4 + 1 as int))").alias("denoiser"))
    return rows.select("p_partkey", M.config_faults(rows, {"size": 40}).alias("faults"))


MANIFEST = {
    "accepted_for_sft": "CASE WHEN doc_id % 3 = 0 THEN 'True' ELSE 'false' END", "split": "CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END", "action_joint14_path": "CASE WHEN doc_id % 7 = 0 THEN '' ELSE source END",
    "quality_flags": "CASE WHEN doc_id % 11 = 0 THEN 'x;hard_negative_prompt_action_mismatch' ELSE 'x' END", "human_label": "CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'PASS' END", "qc_status": "CASE doc_id % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'warn' WHEN 2 THEN 'Reject' ELSE 'pass' END",
    "qc_labels": "CASE WHEN doc_id % 13 = 0 THEN 'possible_object_motion_without_contact' ELSE '' END", "hard_fail_reason": "CASE WHEN doc_id % 17 = 0 THEN 'fps_invalid' ELSE '' END",
}
MANIFEST_SQL = "m AS (SELECT doc_id, lang, source, n_chars, " + ", ".join(f"{e} AS {n}" for n, e in MANIFEST.items()) + " FROM documents)"


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), MANIFEST)


@query(f"""WITH {MANIFEST_SQL}, p AS (SELECT doc_id FROM m WHERE contains(quality_flags, 'hard_negative') ORDER BY doc_id LIMIT 10)
SELECT 'stats_input' AS kind, doc_id FROM m WHERE accepted_for_sft = 'True' AND split = 'train' AND action_joint14_path <> '' UNION ALL SELECT 'for_model', doc_id FROM m WHERE lower(qc_status) IN ('warn', 'reject') OR qc_labels <> '' OR hard_fail_reason <> ''
UNION ALL SELECT 'screen', doc_id FROM m WHERE human_label = '' AND lang = 'en' AND split = 'train' UNION ALL SELECT 'pairs', doc_id FROM p UNION ALL SELECT 'source', doc_id FROM m WHERE split = 'val' UNION ALL SELECT 'all_if_none', doc_id FROM m""")
def manifest_filters(spark, sf_dir):
    """F8, F9, F12, F16, H7, H14."""
    m = _manifest(spark, sf_dir)
    scored = m.where("split = 'val'")
    screen = M.label_filters(True, lang="en", split="train", source=None)
    picked = {"stats_input": M.stats_input(m), "for_model": Q.selected_for_model(m), "screen": m.where(screen), "pairs": M.rejected_pairs(m, limit=10, order="doc_id"), "source": M.training_source(m, scored, "vlm"), "all_if_none": S.filtered_or_all(M.with_text_columns(m, ["note"]), F.col("note") == "none")}
    out = None
    for kind, df in picked.items():
        one = df.select(F.lit(kind).alias("kind"), "doc_id")
        out = one if out is None else out.unionAll(one)
    return out


@query(f"""WITH {MANIFEST_SQL} SELECT doc_id, CASE WHEN hard_fail_reason <> '' THEN 'REJECT' WHEN qc_labels <> '' THEN 'DPO_LOSER_CANDIDATE' WHEN lower(qc_status) = 'pass' THEN 'PASS' ELSE 'WARN_KEEP' END AS vlm_decision,
CASE WHEN hard_fail_reason <> '' THEN 0.95 WHEN qc_labels <> '' THEN 0.72 WHEN lower(qc_status) = 'pass' THEN 0.82 WHEN lower(qc_status) = 'reject' THEN 0.65 ELSE 0.68 END::DOUBLE AS vlm_confidence FROM m""")
def stand_in_verdicts(spark, sf_dir):
    """D-8."""
    made = Q.stand_in_verdict((F.col("hard_fail_reason") != "").cast("string"), "qc_status", "qc_labels")
    return _manifest(spark, sf_dir).select("doc_id", *(c.alias(n) for n, c in made.items()))


@query("""SELECT d.doc_id, d.lang, CASE l.quality WHEN 1 THEN 'PASS' WHEN 0 THEN 'REJECT' ELSE 'NEED_HUMAN_REVIEW' END AS vlm_decision, coalesce(l.toxic, 0)::DOUBLE AS vlm_confidence FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def verdict_defaults(spark, sf_dir):
    """Only new columns of the right, and defaults where it has no row."""
    right = table(spark, sf_dir, "labels").select("doc_id", F.lit("?").alias("lang"), F.when(F.col("quality") == 1, "PASS").otherwise("REJECT").alias("vlm_decision"), F.col("toxic").cast("double").alias("vlm_confidence"))
    return Q.with_verdict(table(spark, sf_dir, "documents").select("doc_id", "lang"), right, ["doc_id"])


@query("""WITH n AS (SELECT p_partkey, p_brand, row_number() OVER (ORDER BY p_partkey) - 1 AS row_index FROM part), q AS (SELECT s_suppkey, s_acctbal, row_number() OVER (ORDER BY s_suppkey) - 1 AS row_index FROM supplier)
SELECT n.row_index, p_partkey, s_acctbal, NULL::VARCHAR AS blockiness, coalesce('new-' || s_suppkey::VARCHAR, p_brand) AS p_brand FROM n LEFT JOIN q ON n.row_index = q.row_index""")
def positions_and_updates(spark, sf_dir):
    """Scores attached by position, and a column updated by key where there is something new."""
    place = lambda df, key: df.withColumn("row_index", F.col(key))  # noqa: E731  keys count from 0 without gaps
    left, right = place(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey"), place(table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), "s_suppkey")
    both = Q.attach_by_index(left, right, "row_index", ["s_acctbal", "blockiness"])
    news = right.select("row_index", F.concat(F.lit("new-"), F.col("s_suppkey").cast("string")).alias("p_brand"))
    return Q.update_by_key(both, news, "row_index", "p_brand").select("row_index", "p_partkey", "s_acctbal", "blockiness", "p_brand")


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, min_by(l_partkey, l_shipdate) AS p FROM lineitem GROUP BY ALL) SELECT n_nationkey, n_name, n_regionkey, coalesce(r_name, '') AS r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey < 3""")
def dimension_lookups(spark, sf_dir):
    """A dimension looked up by key, '' where it has no row."""
    dim = table(spark, sf_dir, "region").where("r_regionkey < 3").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return table(spark, sf_dir, "nation").join(F.broadcast(dim), "n_regionkey", "left").select("n_nationkey", "n_name", "n_regionkey", F.coalesce("r_name", F.lit("")).alias("r_name"))


@query("""WITH e AS (SELECT unnest(list_slice(list_filter(list_transform(string_split(props, ','), lambda x: trim(x)), lambda x: x <> ''), 1, 2)) AS token FROM events WHERE event_type IN ('click', 'view')) SELECT token, count(*) AS n FROM e GROUP BY token ORDER BY n DESC, token LIMIT 12""")
def evidence_counts(spark, sf_dir):
    """A5: pieces of evidence of some decisions."""
    rows = table(spark, sf_dir, "events").select("event_type", F.replace("props", F.lit(","), F.lit("|")).alias("evidence"))
    return A.evidence_counts(rows, "event_type", "evidence", ("click", "view"))


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE l_quantity > 25) AS large, count(*) FILTER (WHERE l_discount = 0) AS plain FROM lineitem""")
def step_counts(spark, sf_dir):
    """A22."""
    return A.step_counts(table(spark, sf_dir, "lineitem"), {"large": F.col("l_quantity") > 25, "plain": F.col("l_discount") == 0})


@query("WITH f AS (SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 80) SELECT round(avg(l_quantity), 6) AS l_quantity, round(avg(l_tax), 6) AS l_tax FROM f")
def first_rows_mean(spark, sf_dir):
    """A28."""
    out = A.first_rows_mean(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], ["l_quantity", "l_tax"])
    return out.select(*(rounded(c).alias(c) for c in out.columns))


@query("SELECT o_orderpriority, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS readable, count(*) FILTER (WHERE o_orderstatus <> 'F') AS unreadable FROM orders GROUP BY o_orderpriority")
def readable_totals(spark, sf_dir):
    """A30."""
    return A.readable_totals(table(spark, sf_dir, "orders").withColumn("ok", F.col("o_orderstatus") == "F"), "o_orderpriority", "ok")


@query("""WITH s AS (SELECT n_regionkey AS k, 10 * sum((n_nationkey % 3 = 0)::INT) + 5 * sum((n_nationkey % 2 = 0)::INT) - avg(coalesce(nullif(n_nationkey % 4, 0), 999)) AS s FROM nation GROUP BY n_regionkey), b AS (SELECT k::VARCHAR AS k, round(s, 6) AS s FROM s ORDER BY s DESC, k LIMIT 1)
SELECT 'ranked' AS kind, k AS robot, s AS score, 'best score' AS reason FROM b UNION ALL SELECT 'none', 'aloha', NULL, 'no successful trial, default'""")
def chosen_embodiment(spark, sf_dir):
    """The best robot, or the default if no trial went well."""
    rows = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("robot"), (F.col("n_nationkey") % 3 == 0).alias("ok"), (F.col("n_nationkey") % 2 == 0).alias("out"), (F.col("n_nationkey") % 4).cast("double").alias("d"))
    pick = lambda df, kind: A.selected_embodiment(A.embodiment_ranking(df, "robot", "ok", "out", "d"), "robot", "aloha").select(F.lit(kind).alias("kind"), "robot", "score", "reason")
    return pick(rows, "ranked").unionAll(pick(rows.where("false"), "none"))


@query("""SELECT 'after' AS kind, coalesce(min(doc_id) FILTER (WHERE quality = 0 AND doc_id > 50), min(doc_id) FILTER (WHERE quality = 0), 0) AS next FROM labels UNION ALL SELECT 'wrapped', coalesce(min(doc_id) FILTER (WHERE quality = 0), 0) FROM labels UNION ALL SELECT 'none', 0""")
def next_unlabelled(spark, sf_dir):
    """The next row without a label, else the first, else 0."""
    rows = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("i"), F.when(F.col("quality") == 1, "PASS").otherwise("").alias("l"))
    made = {"after": S.next_unlabelled(rows, "i", "l", 50), "wrapped": S.next_unlabelled(rows, "i", "l", 1 << 40), "none": S.next_unlabelled(rows.where("l <> ''"), "i", "l", 0)}
    out = None
    for kind, df in made.items():
        one = df.select(F.lit(kind).alias("kind"), "next")
        out = one if out is None else out.unionAll(one)
    return out


HASH = "(c_custkey * 2654435761) % 1000003"


@query(f"""WITH a AS (SELECT c_custkey, 'random' AS sample_group FROM customer ORDER BY {HASH}, c_custkey LIMIT 20), b AS (SELECT c_custkey, 'hard' AS sample_group FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM a) ORDER BY c_acctbal DESC, c_custkey LIMIT 10),
c AS (SELECT c_custkey, 'fill' AS sample_group FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM a) AND c_custkey NOT IN (SELECT c_custkey FROM b) ORDER BY {HASH}, c_custkey LIMIT 15) SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""")
def composed_sample(spark, sf_dir):
    """L14, U2."""
    return S.composed_sample(table(spark, sf_dir, "customer"), "c_custkey", 20, 10, 45, "c_acctbal").select("c_custkey", "sample_group")


@query("""WITH t AS (SELECT item_id, unnest([0, 1, 2]) AS k, text FROM benchmark WHERE text IS NOT NULL) SELECT item_id, k, CASE k WHEN 2 THEN trim(' x ' || text, ' ') ELSE trim(text, ' ') END AS core FROM t""")
def prompt_openings(spark, sf_dir):
    """Both fixed openings go, in any case; other texts stay."""
    first = "In a fixed robotic workspace, generate a rigid, physically consistent embodied robotic arm. The arm maintains high stability with no deformation and enters the frame to "
    said = F.when(F.col("k") == 0, F.concat(F.lit(first.upper()), "text")).when(F.col("k") == 1, F.concat(F.lit("  in a fixed robotic workspace, one arm enters the frame to "), "text")).otherwise(F.concat(F.lit(" x "), "text"))
    rows = table(spark, sf_dir, "benchmark").where("text is not null").select("item_id", F.explode(F.array(*map(F.lit, range(3)))).alias("k"), "text")
    return rows.select("item_id", "k", X.core_text(said).alias("core"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 0 END AS n, CASE o_orderkey % 3 WHEN 0 THEN 'a|' || o_orderstatus WHEN 1 THEN 'a|b|' || o_orderstatus ELSE '' END AS labels FROM orders""")
def label_lists(spark, sf_dir):
    """A JSON list, a text with commas and semicolons, and nothing."""
    s = F.col("o_orderstatus")
    said = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('["a", "'), s, F.lit('"]'))).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("a, b;;"), s))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.label_list(said).alias("l")).select("o_orderkey", F.size("l").alias("n"), F.array_join("l", "|").alias("labels"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'DPO_LOSER' ELSE 'WARN' END AS vlm_decision, least(1, greatest(0, (event_id % 15 - 2) / 10))::DOUBLE AS vlm_confidence, least(2, event_id % 4)::INT AS vlm_domain_score, 1 AS vlm_physics_score, 'a; b' AS vlm_evidence FROM events""")
def short_verdicts(spark, sf_dir):
    """X24."""
    e = F.col("event_id")
    said = F.concat(F.lit('so: {"vlm_decision": "'), F.when(e % 3 == 0, "pass").when(e % 3 == 1, "dpo_loser").otherwise("?"), F.lit('", "confidence": '), ((e % 15 - 2) / 10).cast("string"), F.lit(', "vlm_domain_score": '), (e % 4).cast("string"), F.lit(', "evidence": ["a", "b"]}'))
    return table(spark, sf_dir, "events").select("event_id", X.short_verdict(said).alias("v")).select("event_id", "v.vlm_decision", "v.vlm_confidence", "v.vlm_domain_score", "v.vlm_physics_score", "v.vlm_evidence")


@query("""SELECT p_partkey, 'You check clips.' || chr(10) || chr(10) || 'Look at contact.' || chr(10) || chr(10) || 'Task family: ' || replace(replace(p_type, ' ', '_'), '_', ' ') || chr(10) || chr(10) || 'Prompt: ' || p_name || chr(10) || chr(10) || 'Rule context: {"p_size":' || p_size::VARCHAR || ',"p_brand":"' || p_brand || '"}' AS prompt FROM part""")
def review_prompts(spark, sf_dir):
    """X17, X26."""
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", X.review_prompt("You check clips.", "Look at contact.", F.replace("p_type", F.lit(" "), F.lit("_")), F.col("p_name"), X.rule_context("p_size", "p_brand")).alias("prompt"))


@query("SELECT n_regionkey, min_by(n_name, n_nationkey) AS overlay FROM nation WHERE n_nationkey IN (1, 3, 5, 8) GROUP BY n_regionkey")
def first_overlays(spark, sf_dir):
    """Of each folder's files the one whose name comes first in a list."""
    nation = table(spark, sf_dir, "nation")
    order = [r.n_name for r in nation.where("n_nationkey in (1, 3, 5, 8)").orderBy("n_nationkey").collect()]
    found = M.first_overlay(nation.withColumn("path", F.concat(F.lit("dir/"), "n_name")), "n_regionkey", "path", order)
    return found.select("n_regionkey", F.element_at(F.split("overlay", "/"), -1).alias("overlay"))


@query("""SELECT 'a' AS kind, true AS passed UNION ALL SELECT 'b', false UNION ALL SELECT 'c', false""")
def probe_gate(spark, sf_dir):
    """Any report that passed, none, and no reports."""
    reports = table(spark, sf_dir, "region").select(F.concat(F.lit('{"probe_pass": '), F.when(F.col("r_regionkey") == 2, "true").otherwise('"no"'), F.lit("}")).alias("v"), "r_regionkey")
    out = None
    for kind, df in {"a": reports, "b": reports.where("r_regionkey <> 2"), "c": reports.where("false")}.items():
        one = P.probe_passed(df, "v").select(F.lit(kind).alias("kind"), "passed")
        out = one if out is None else out.unionAll(one)
    return out


@query("""SELECT * FROM (VALUES ('wa_clean_fixed', false, 1.0::DOUBLE, 0.0::DOUBLE, 1), ('wa_mild_random', true, 0.7::DOUBLE, 0.02::DOUBLE, 2), ('wa_hard_success', true, 0.35::DOUBLE, 0.03::DOUBLE, 3)) v(profile, cluttered_table, clean_background_rate, random_table_height, place)""")
def randomisation_profiles(spark, sf_dir):
    """H9: settings of the profiles, of those that are switched on."""
    names = P.enabled_profiles(True, True)
    place = F.array_position(F.array(*map(F.lit, names)), F.col("profile")).cast("int")
    return P.profile_settings(spark).select("profile", "cluttered_table", "clean_background_rate", "random_table_height", place.alias("place"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'yes 1' WHEN 1 THEN 'yes 2' ELSE 'default' END AS answer FROM customer""")
def retried_answers(spark, sf_dir):
    """A model that answers at once, after a correction, or never."""
    from tracklode.streaming.progress import retried

    @F.pandas_udf("string")
    def asked(keys):
        def one(key: int) -> str:
            calls = []

            def model(prompt: str) -> str:
                calls.append(prompt)
                if key % 3 == 2 and len(calls) == 1:
                    raise RuntimeError("no answer")
                return f"yes {len(calls)}" if key % 3 == 0 or (key % 3 == 1 and "please" in prompt) else "?"

            return retried(model, "go", lambda a: a.startswith("yes"), "please", default="default")

        return keys.map(one)

    return table(spark, sf_dir, "customer").select("c_custkey", asked("c_custkey").alias("answer"))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'NEED_HUMAN_REVIEW' WHEN p_size % 4 = 1 THEN 'PASS' ELSE 'REJECT' END AS vlm_decision, CASE WHEN p_size % 4 = 0 THEN 0 WHEN p_size % 4 = 3 THEN 1 ELSE 0.9 END::DOUBLE AS vlm_confidence FROM part""")
def model_verdicts(spark, sf_dir):
    """§2.12: a backend behind the hook, which answers, answers after a correction, or never; and one without a model."""

    def load():
        def model(prompt: str) -> str:
            size = int(prompt.split()[0])
            if size % 4 == 0 or (size % 4 == 3 and "JSON" not in prompt):
                return "I would say it is fine"
            return f'so: {{"overall_decision": "{"PASS" if size % 4 == 1 else "REJECT"}", "confidence": {1 if size % 4 == 3 else 0.9}}}'

        return model

    part = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", F.col("p_size").cast("string"), "p_name").alias("prompt"))
    said = models.with_answer(part, "prompt", load, lambda a: "{" in a, "Answer in JSON only.")
    return said.select("p_partkey", X.verdict("answer").alias("v")).select("p_partkey", F.col("v.overall_decision").alias("vlm_decision"), F.col("v.confidence").alias("vlm_confidence"))


@query("""WITH i AS (SELECT n_nationkey, n_nationkey * 3 AS c, unnest(range(0, 6)) AS i FROM nation WHERE n_nationkey > 0), f AS (SELECT DISTINCT n_nationkey, CASE WHEN c <= 6 THEN CASE WHEN i < c THEN i END ELSE round_even(i * (c - 1) / 5.0, 0) END::BIGINT AS frame FROM i)
SELECT n_nationkey, (row_number() OVER (PARTITION BY n_nationkey ORDER BY frame) - 1)::INT AS place, frame FROM f WHERE frame IS NOT NULL""")
def frames_table_function(spark, sf_dir):
    """§2.12: a table function in SQL."""
    models.register_frames(spark)
    table(spark, sf_dir, "nation").createOrReplaceTempView("clips_of_nations")
    return spark.sql("SELECT n_nationkey, f.place, f.frame FROM clips_of_nations, LATERAL even_frames(n_nationkey * 3, 6) f")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 996 WHEN 2 THEN 3 ELSE 997 END AS rc, CASE c_custkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 1 END AS attempts, CASE c_custkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 0 END AS done FROM customer""")
def job_attempts(spark, sf_dir):
    """T4: jobs that reach their target, that never do, that fail, and that cannot be run."""

    @F.pandas_udf("rc int, attempts int, done int")
    def ran(keys: pd.Series) -> pd.DataFrame:
        def one(key: int) -> dict[str, int]:
            done = []

            def run() -> int:
                if key % 4 == 3:
                    raise OSError("no simulator")
                done.extend([1] * (key % 4 != 1))
                return 3 if key % 4 == 2 else 0

            return P.run_until(run, lambda: len(done), 2, 3)

        return pd.DataFrame([one(k) for k in keys])

    return table(spark, sf_dir, "customer").select("c_custkey", ran("c_custkey").alias("r")).select("c_custkey", "r.rc", "r.attempts", "r.done")


@query("SELECT conv_id, turn, CASE role WHEN 'user' THEN 'a,b' ELSE 'c' END AS words FROM conversations")
def ordered_unique(spark, sf_dir):
    """H1: trimmed, in lower case, each once, in order."""
    raw = F.when(F.col("role") == "user", F.array(F.lit(" A "), F.lit("b"), F.lit(""), F.lit("a"))).otherwise(F.array(F.lit("c"), F.lit("C ")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(expr.unique_in_order(raw), ",").alias("words"))
