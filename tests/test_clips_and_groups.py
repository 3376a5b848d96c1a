"""Clip kernels on clips with known answers, and groupings next to plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklode.functions import clips as C
from tracklode.functions import vision as V
from tracklode.operators import quantiles as Z
from tracklode.queries_io import _clip_frames


@pytest.fixture(scope="module")
def figures(spark):
    return {r.path: r for r in C.clip_metrics(_clip_frames(spark)).collect()}


def test_foreground_that_comes_in_is_no_flicker(figures):
    r = figures["enter"]
    assert r.frames == 24 and r.global_content_rgb_shift_score > 15 and r.global_content_brightness_step > 3
    assert r.background_luma_flicker_score < 6 and not r.illumination_flicker_candidate and not r.true_color_shift_candidate


def test_a_jump_of_exposure_is_flicker(figures):
    r = figures["jump"]
    assert r.background_luma_flicker_score > 8 and r.background_changed_area_ratio > 0.55 and r.illumination_flicker_candidate and r.background_mask_reliable


def scene(background=235, robot=None, thing=None, tint=(0, 0, 0)):
    img = np.full((120, 160, 3), background, np.int16) + np.array(tint)
    for box, color in ((robot, (30, 30, 30)), (thing, (40, 130, 220))):
        if box:
            x, y, w, h = box
            img[y : y + h, x : x + w] = color
    return np.clip(img, 0, 255).astype(np.uint8)


def test_a_tint_of_the_background_is_a_color_shift():
    still = [scene(210, (20, 30, 20, 30)) for _ in range(6)]
    tinted = [scene(210, (20, 30, 20, 30), tint=(0, 0, 0) if k < 3 else (-30, 0, 18)) for k in range(6)]
    assert not C.clip_figures(still)["true_color_shift_candidate"]
    got = C.clip_figures(tinted)
    assert got["true_color_shift_candidate"] and got["background_color_shift_score"] > 6 and got["background_color_direction_consistency"] == 1.0


def test_an_object_that_moves_alone_has_no_contact():
    alone = [scene(robot=(5, 20, 20, 30), thing=(100 + 4 * k, 80, 24, 16)) for k in range(6)]
    held = [scene(robot=(60 + 4 * k, 60, 30, 30), thing=(92 + 4 * k, 66, 24, 16)) for k in range(6)]
    a, b = (C.clip_figures(x) for x in (alone, held))
    assert a["object_motion_event_count"] == 5 == a["object_motion_no_contact_sustained_frames"] and a["object_motion_without_visible_contact_score"] == 1.0
    assert b["object_motion_no_contact_event_count"] == 0 and b["contact_region_visible_ratio"] == 1.0 and b["robot_visible_ratio"] == 1.0


def test_few_frames_give_zeros():
    for frames in ([], [scene()]):
        got = C.clip_figures(frames)
        assert got["global_content_rgb_shift_score"] == 0 and not got["illumination_flicker_candidate"] and got["object_like_motion_ratio"] == 0
        assert C.flow_figures(frames)["static_clip"]


def test_pieces_and_masks_against_plain_loops():
    rng = np.random.default_rng(2)
    for _ in range(10):
        mask = rng.random((17, 23)) < 0.4
        label, area = C.pieces(mask)
        seen, sizes = np.zeros(mask.shape, bool), []
        for y, x in zip(*np.nonzero(mask)):
            if seen[y, x]:
                continue
            stack, n = [(y, x)], 0
            seen[y, x] = True
            while stack:
                i, j = stack.pop()
                n += 1
                assert label[i, j] == label[y, x]
                for a in range(max(0, i - 1), min(17, i + 2)):
                    for b in range(max(0, j - 1), min(23, j + 2)):
                        if mask[a, b] and not seen[a, b]:
                            seen[a, b] = True
                            stack.append((a, b))
            sizes.append(n)
        assert sorted(sizes) == sorted(area[1:]) and (label > 0).sum() == mask.sum()
        wide = np.array([[mask[max(0, i - 1) : i + 2, max(0, j - 1) : j + 2].any() for j in range(23)] for i in range(17)])
        assert (C.grown(mask, 3) == wide).all()
        other, cover = rng.random((17, 23)) < 0.02, C.shifted_any(mask & (rng.random(mask.shape) < 0.05), C.disc(3))
        few = rng.random((17, 23)) < 0.01
        assert C.near(other, few, 3) == bool((other & C.shifted_any(few, C.disc(3))).any())
        assert cover.shape == mask.shape


def test_flow_of_a_shift():
    field = C.box(np.random.default_rng(0).uniform(0, 255, (100, 140)), 7)
    field = (field - field.min()) / (field.max() - field.min()) * 255
    for down, right in ((0, 0), (2, 0), (0, -3), (1, 2)):
        dy, dx = C.flow(field[10:90, 10:130], field[10 - down : 90 - down, 10 - right : 130 - right])
        assert abs(np.median(dy) - down) < 0.15 and abs(np.median(dx) - right) < 0.15


@pytest.mark.parametrize("batch", [3, 4096])
def test_leaders_in_order(spark, batch):
    rnd = random.Random(1)
    base = ["".join(rnd.choice("01") for _ in range(32)) for _ in range(8)]
    rows = []
    for i in range(120):
        c = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 5)):
            c[rnd.randrange(32)] = rnd.choice("01")
        rows.append((i * 7 % 120, "".join(c)))
    leaders, want = [], {}
    for i, c in sorted(rows):
        near = next((k for k, x in leaders if sum(a != b for a, b in zip(c, x)) <= 4), None)
        if near is None:
            leaders.append((i, c))
        want[i] = i if near is None else near
    df = spark.createDataFrame([*rows, (999, None)], "id long, code string").repartition(3)
    got = {r.id: r.group_id for r in V.leader_groups(df, "id", "code", 4, batch).collect()}
    assert got == want
    assert V.leader_groups(df.where("false"), "id", "code").count() == 0


def test_kmeans_finds_separate_groups(spark):
    rnd = random.Random(3)
    rows = [(i, [10.0 * (i % 3) + rnd.gauss(0, 0.1), 5.0 * (i % 3 == 1) + rnd.gauss(0, 0.1), rnd.gauss(0, 1e-3)]) for i in range(90)]
    got = V.kmeans_clusters(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", k=3).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.cluster, set()).add(r.id % 3)
    assert len(got) == 90 and len(groups) == 3 and all(len(g) == 1 for g in groups.values())


@pytest.mark.parametrize("ranges", [4, 1024])
def test_quantiles_equal_numpys(spark, monkeypatch, ranges):
    monkeypatch.setattr(Z, "RANGES", ranges)
    rnd = random.Random(4)
    groups = {0: [rnd.gauss(0, 1) for _ in range(501)], 1: [float(rnd.randint(0, 5)) for _ in range(300)], 2: [1e9] + [rnd.random() for _ in range(50)], 3: [7.5], 4: [2.0] * 40}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [(5, None), (0, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(4)
    shares = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.95, "e": 1.0}
    got = {r.g: r for r in Z.quantiles(df, ["g"], "v", shares).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5} and all(got[5][n] is None for n in shares)
    for g, vs in groups.items():
        assert np.allclose([got[g][n] for n in shares], [np.quantile(vs, p) for p in shares.values()], rtol=1e-12)
    one = Z.quantile_row(df, {"x": (F.col("v"), 0.5), "y": (F.col("g"), 0.9)}).first()
    every = [v for vs in groups.values() for v in vs]
    assert one.x == pytest.approx(np.quantile(every, 0.5)) and one.y == pytest.approx(np.quantile([g for g, _ in rows], 0.9))
    assert Z.quantiles(df.where("false"), [], "v", shares).first().asDict() == dict.fromkeys(shares)
