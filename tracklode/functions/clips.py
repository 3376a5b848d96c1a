"""Kernels over clips: masks of background, robot, objects and motion, and what follows from them.

Frames are arrays of height, width and blue, green, red in 8 bits. A clip is its sampled frames, some dozens, so each
clip is worked on in one call; ``clip_metrics`` brings the calls to the executors, a clip a group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

# Weights, thresholds and names of the metrics that results depend on.
LUMA_BGR = (0.114, 0.587, 0.299)
EDGE_LOW, EDGE_HIGH = 45, 120
MOTION_STEP = 12
PALE_VALUE, PALE_SATURATION = 145, 58
WHITE_VALUE, WHITE_SATURATION = 185, 75
DARK_VALUE, DARK_SATURATION = 105, 135
EDGE_VALUE, EDGE_SATURATION = 135, 90
VIVID_SATURATION, VIVID_VALUE = 55, 55
TINTED_VALUE_LOW, TINTED_VALUE_HIGH, TINTED_SATURATION = 70, 205, 25
RELIABLE_SHARE, RELIABLE_PIXELS = 0.18, 1200
COMMON_SHARE, COMMON_PIXELS, COMMON_PAIRS = 0.12, 900, 0.35
LUMA_STEP, LUMA_AREA, LUMA_SCORE, LUMA_SIGN, LUMA_FOREGROUND = 8.0, 0.55, 8.0, 0.75, 0.10
COLOR_STEP, COLOR_AREA, COLOR_SCORE, COLOR_DIRECTION = 6.0, 0.45, 6.0, 0.70
ROBOT_SEEN, NEAR_RADIUS, CONTACT_RADIUS, EVENT_SHARE, EVENT_PIXELS = 0.006, 14, 18, 0.0012, 28
FLOW_MEAN, FLOW_HIGH, STILL_RATIO, STILL_ENERGY, WILD_RATIO, WILD_ENERGY = 0.25, 1.2, 0.03, 0.25, 0.90, 18.0
METRICS = [
    "global_content_rgb_shift_score", "global_content_brightness_step", "foreground_area_change_score",
    "background_luma_flicker_score", "background_changed_area_ratio", "background_delta_sign_consistency", "background_reliable_pair_ratio", "foreground_area_delta_during_bg_change",
    "background_color_shift_score", "background_color_changed_area_ratio", "background_color_direction_consistency",
    "robot_visible_ratio", "robot_near_object_ratio", "contact_region_visible_ratio", "object_motion_without_visible_contact_score", "object_like_motion_ratio", "motion_score",
]
COUNTS = ["object_motion_event_count", "object_motion_no_contact_event_count", "object_motion_no_contact_sustained_frames"]
FLAGS = ["background_mask_reliable", "illumination_flicker_candidate", "true_color_shift_candidate"]


# ---- pixels ---------------------------------------------------------------------------------------------


def luma(frame: np.ndarray) -> np.ndarray:
    return np.rint(frame.astype(np.float64) @ LUMA_BGR).astype(np.int16)


def saturation_and_value(frame: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top, low = frame.max(axis=2).astype(np.float64), frame.min(axis=2).astype(np.float64)
    return np.rint(np.divide(255 * (top - low), top, out=np.zeros_like(top), where=top > 0)), top


def lab(frame: np.ndarray) -> np.ndarray:
    """Lightness in 0..255 and the two colour axes around 128, of sRGB under daylight."""
    rgb = frame[..., ::-1].astype(np.float64) / 255
    linear = np.where(rgb <= 0.04045, rgb / 12.92, ((rgb + 0.055) / 1.055) ** 2.4)
    xyz = linear @ np.array([[0.412453, 0.212671, 0.019334], [0.357580, 0.715160, 0.119193], [0.180423, 0.072169, 0.950227]]) / [0.950456, 1.0, 1.088754]
    f = np.where(xyz > 0.008856, np.cbrt(xyz), 7.787 * xyz + 16 / 116)
    lightness = np.where(xyz[..., 1] > 0.008856, 116 * f[..., 1] - 16, 903.3 * xyz[..., 1])
    return np.rint(np.stack([lightness * 2.55, 500 * (f[..., 0] - f[..., 1]) + 128, 200 * (f[..., 1] - f[..., 2]) + 128], axis=-1))


def shifted_any(mask: np.ndarray, offsets: Sequence[tuple[int, int]]) -> np.ndarray:
    """Whether any pixel at one of the offsets (rows, columns) is set; what lies outside is not."""
    reach = max(max(abs(y), abs(x)) for y, x in offsets)
    wide, (h, w) = np.pad(mask, reach), mask.shape
    return np.logical_or.reduce([wide[reach + y : reach + y + h, reach + x : reach + x + w] for y, x in offsets])


def grown(mask: np.ndarray, size: int) -> np.ndarray:
    r = range(-(size // 2), size // 2 + 1)
    return shifted_any(shifted_any(mask, [(0, x) for x in r]), [(y, 0) for y in r])


def shrunk(mask: np.ndarray, size: int) -> np.ndarray:
    return ~grown(~mask, size)


def disc(radius: int) -> list[tuple[int, int]]:
    """Offsets of a filled circle, a stretch of columns for each row."""
    wide = [int(np.rint(np.sqrt(max(0.0, radius**2 - y**2)))) for y in range(-radius, radius + 1)]
    return [(y - radius, x) for y, w in enumerate(wide) for x in range(-w, w + 1)]


def near(a: np.ndarray, b: np.ndarray, radius: int) -> bool:
    """Whether a pixel of ``a`` lies within a circle around one of ``b``. Only borders of ``b`` and what it covers can decide."""
    if not a.any() or not b.any():
        return False
    if (a & b).any():
        return True
    (ay, ax), (by, bx) = np.nonzero(a & ~shrunk(a, 3)), np.nonzero(b & ~shrunk(b, 3))
    width = np.zeros(2 * radius + 1, np.int64)
    for y, x in disc(radius):
        width[y + radius] = max(width[y + radius], x)
    for s in range(0, len(ay), 512):
        dy, dx = np.abs(ay[s : s + 512, None] - by), np.abs(ax[s : s + 512, None] - bx)
        inside = dy <= radius
        if (inside & (dx <= width[np.minimum(dy, radius) + radius])).any():
            return True
    return False


def pieces(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the connected piece (by eight neighbours) of each pixel, from 1, and the pieces' sizes; joined by runs of rows."""
    h, w = mask.shape
    step = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(step == 1)
    _, stop = np.nonzero(step == -1)
    parent = np.arange(len(row))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.searchsorted(row, np.arange(h + 1))
    for y in range(1, h):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if start[i] <= stop[j] and start[j] <= stop[i]:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
            if stop[i] < stop[j]:
                i += 1
            else:
                j += 1
    roots, label = np.unique([find(i) for i in range(len(row))], return_inverse=True) if len(row) else (np.zeros(0), np.zeros(0, np.int64))
    out = np.zeros((h, w), np.int64)
    for k, y, a, b in zip(label, row, start, stop):
        out[y, a:b] = k + 1
    return out, np.bincount(out.ravel(), minlength=len(roots) + 1)


def tidied(mask: np.ndarray, size: int, least: int) -> np.ndarray:
    """The mask without specks and gaps of less than ``size``, and without pieces of fewer than ``least`` pixels."""
    smooth = grown(shrunk(mask, size), size)
    label, area = pieces(shrunk(grown(smooth, size), size))
    keep = area >= least
    keep[0] = False
    return keep[label]


def gradients(gray: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    g = np.pad(gray.astype(np.int64), 1, mode="edge")
    across = lambda a: a[:-2] + 2 * a[1:-1] + a[2:]
    return across(g)[:, 2:] - across(g)[:, :-2], across(g.T)[:, 2:].T - across(g.T)[:, :-2].T


def outlines(gray: np.ndarray) -> np.ndarray:
    """Edges: ridges of the gradient that hold a strong pixel, thinned across their direction."""
    dx, dy = gradients(gray)
    size = np.abs(dx) + np.abs(dy)
    wide = np.pad(size, 1)
    at = lambda y, x: wide[1 + y : 1 + y + size.shape[0], 1 + x : 1 + x + size.shape[1]]
    flat, steep = np.abs(dy) < 0.41421356 * np.abs(dx), np.abs(dy) > 2.41421356 * np.abs(dx)
    down = (dx >= 0) == (dy >= 0)
    ridge = np.select(
        [flat, steep, down], [(size > at(0, -1)) & (size >= at(0, 1)), (size > at(-1, 0)) & (size >= at(1, 0)), (size > at(-1, -1)) & (size > at(1, 1))], (size > at(-1, 1)) & (size > at(1, -1))
    )
    label, area = pieces(ridge & (size > EDGE_LOW))
    strong = np.zeros(len(area), bool)
    strong[np.unique(label[ridge & (size > EDGE_HIGH)])] = True
    strong[0] = False
    return strong[label]


# ---- masks ----------------------------------------------------------------------------------------------


@dataclass
class Masks:
    background: np.ndarray
    foreground: np.ndarray
    robot: np.ndarray
    objects: np.ndarray
    motion: np.ndarray
    reliable: bool
    gray: np.ndarray
    lab: np.ndarray
    color: np.ndarray  # mean of blue, green, red


def masks(frame: np.ndarray, before: np.ndarray | None = None) -> Masks:
    """Masks of one frame, motion against the frame before.

    Background is pale and smooth, a robot dark or at edges without colour, objects coloured. Motion does not count
    against background: a change of exposure moves all of it, and that is what is looked for there.
    """
    pixels = frame.shape[0] * frame.shape[1]
    gray, (s, v) = luma(frame), saturation_and_value(frame)
    edge = grown(outlines(gray), 5)
    motion = np.zeros(gray.shape, bool)
    if before is not None:
        motion = grown(tidied(np.abs(gray - luma(before)) > MOTION_STEP, 3, 18), 3)
    robot = tidied(((v < DARK_VALUE) & (s < DARK_SATURATION)) | ((v < EDGE_VALUE) & (s < EDGE_SATURATION) & edge), 3, max(18, pixels // 2500))
    tinted = (v > TINTED_VALUE_LOW) & (v < TINTED_VALUE_HIGH) & (s > TINTED_SATURATION)
    objects = tidied((((s > VIVID_SATURATION) & (v > VIVID_VALUE)) | tinted) & ~robot, 3, max(12, pixels // 5000))
    pale = ((v > PALE_VALUE) & (s < PALE_SATURATION)) | ((v > WHITE_VALUE) & (s < WHITE_SATURATION))
    background = tidied(pale & ~edge & ~robot & ~objects, 5, max(64, pixels // 300))
    foreground = tidied((robot | objects | edge | motion) & ~background, 3, 12)
    reliable = bool(background.mean() > RELIABLE_SHARE and background.sum() > RELIABLE_PIXELS)
    return Masks(background, foreground, robot, objects, motion, reliable, gray, lab(frame), frame.reshape(-1, 3).mean(axis=0))


def clip_masks(frames: Sequence[np.ndarray]) -> list[Masks]:
    return [masks(f, frames[k - 1] if k else None) for k, f in enumerate(frames)]


# ---- metrics --------------------------------------------------------------------------------------------


def most(values: Sequence[float]) -> float:
    return max((float(v) for v in values if np.isfinite(v)), default=0.0)


def content_steps(seen: Sequence[Masks]) -> dict[str, float]:
    """Largest steps of the whole frame's colour and brightness, and of the foreground's share."""
    pairs = list(zip(seen, seen[1:]))
    return {
        "global_content_rgb_shift_score": most([np.linalg.norm(b.color - a.color) for a, b in pairs]),
        "global_content_brightness_step": most([abs(b.gray.mean() - a.gray.mean()) for a, b in pairs]),
        "foreground_area_change_score": most([abs(b.foreground.mean() - a.foreground.mean()) for a, b in pairs]),
    }


def shared_background(seen: Sequence[Masks]) -> tuple[list[tuple[Masks, Masks, np.ndarray]], float, bool]:
    """Neighbouring frames with enough background in common, their share of all, and whether they are enough to judge by."""
    pairs = [(a, b, a.background & b.background) for a, b in zip(seen, seen[1:])]
    good = [(a, b, both) for a, b, both in pairs if a.reliable and b.reliable and both.mean() > COMMON_SHARE and both.sum() > COMMON_PIXELS]
    every = max(len(pairs), 1)
    return good, len(good) / every, len(good) >= max(2, int(COMMON_PAIRS * every))


def luma_flicker(seen: Sequence[Masks]) -> dict[str, float | bool]:
    """How the lightness of shared background changes: a foreground that comes in leaves it as it is, a jump of exposure does not."""
    good, ratio, enough = shared_background(seen)
    steps = [(b.lab[..., 0] - a.lab[..., 0])[both] for a, b, both in good]
    changed = [d[np.abs(d) > LUMA_STEP] for d in steps]
    score, area = most([abs(np.median(d)) for d in steps]), most([len(c) / len(d) for c, d in zip(changed, steps)])
    sign = most([max((c > 0).mean(), 1 - (c > 0).mean()) for c in changed if len(c)])
    grown_by = most([abs(b.foreground.mean() - a.foreground.mean()) for a, b, _ in good])
    return {
        "background_luma_flicker_score": score, "background_changed_area_ratio": area, "background_delta_sign_consistency": sign, "background_reliable_pair_ratio": ratio,
        "background_mask_reliable": enough, "foreground_area_delta_during_bg_change": grown_by,
        "illumination_flicker_candidate": bool(enough and area > LUMA_AREA and score > LUMA_SCORE and sign > LUMA_SIGN and grown_by < LUMA_FOREGROUND),
    }


def color_shift(seen: Sequence[Masks]) -> dict[str, float | bool]:
    """How far, how widely and how much in one direction the colour of shared background moves."""
    good, _, enough = shared_background(seen)
    scores, areas, directions = [], [], []
    for a, b, both in good:
        d = (b.lab[..., 1:] - a.lab[..., 1:])[both]
        middle = np.median(d, axis=0)
        far = d[np.linalg.norm(d, axis=1) > COLOR_STEP]
        scores.append(np.linalg.norm(middle))
        areas.append(len(far) / len(d))
        along = far @ middle
        directions.append(max((along > 0).mean(), (along < 0).mean()) if len(far) and scores[-1] > 1e-3 else 0.0)
    score, area, direction = most(scores), most(areas), most(directions)
    return {
        "background_color_shift_score": score, "background_color_changed_area_ratio": area, "background_color_direction_consistency": direction,
        "true_color_shift_candidate": bool(enough and score > COLOR_SCORE and area > COLOR_AREA and direction > COLOR_DIRECTION),
    }


def contact_motion(seen: Sequence[Masks]) -> dict[str, float | int]:
    """How often robot and objects are seen together, and how often objects move with no robot near."""
    close = [near(m.robot, m.objects, NEAR_RADIUS) for m in seen]
    contact = [c or bool((m.robot & m.objects).any()) for c, m in zip(close, seen)]
    alone = []  # for each step: None without an event, else whether nothing of a robot is near
    for a, b in zip(seen, seen[1:]):
        moved = b.motion & grown(a.objects | b.objects, 7) & ~grown(b.robot, 5)
        event = moved.mean() > EVENT_SHARE and moved.sum() > EVENT_PIXELS
        alone.append(not near(moved, a.robot | b.robot, CONTACT_RADIUS) if event else None)
    events, lost = sum(x is not None for x in alone), sum(x is True for x in alone)
    run = longest = 0
    for x in alone:
        run = run + 1 if x else 0
        longest = max(longest, run)
    mean = lambda x: float(np.mean(x)) if len(x) else 0.0
    return {
        "robot_visible_ratio": mean([m.robot.mean() > ROBOT_SEEN for m in seen]), "robot_near_object_ratio": mean(close), "contact_region_visible_ratio": mean(contact),
        "object_motion_without_visible_contact_score": lost / events if events >= 2 and longest >= 2 else 0.0, "object_like_motion_ratio": events / max(len(seen) - 1, 1),
        "object_motion_event_count": events, "object_motion_no_contact_event_count": lost, "object_motion_no_contact_sustained_frames": longest,
        "motion_score": mean([m.motion.mean() for m in seen[1:]]),
    }


def clip_figures(frames: Sequence[np.ndarray]) -> dict[str, float | int | bool]:
    """All metrics of a clip; zeros where there are too few frames."""
    seen = clip_masks(frames)
    return content_steps(seen) | luma_flicker(seen) | color_shift(seen) | contact_motion(seen)


# ---- flow -----------------------------------------------------------------------------------------------


def box(a: np.ndarray, size: int) -> np.ndarray:
    """Means over squares, borders repeated."""
    for axis in (0, 1):
        wide = np.pad(a, [(size // 2 + 1, size // 2) if k == axis else (0, 0) for k in (0, 1)], mode="edge")
        total = np.cumsum(wide, axis=axis)
        a = (np.take(total, range(size, total.shape[axis]), axis) - np.take(total, range(0, total.shape[axis] - size), axis)) / size
    return a


def halved(a: np.ndarray) -> np.ndarray:
    return box(a, 3)[::2, ::2]


def sampled(a: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values between pixels, linear in both directions."""
    y, x = np.clip(y, 0, a.shape[0] - 1), np.clip(x, 0, a.shape[1] - 1)
    i, j = np.minimum(y.astype(int), max(a.shape[0] - 2, 0)), np.minimum(x.astype(int), max(a.shape[1] - 2, 0))
    u, v, i1, j1 = y - i, x - j, np.minimum(i + 1, a.shape[0] - 1), np.minimum(j + 1, a.shape[1] - 1)
    return (1 - u) * ((1 - v) * a[i, j] + v * a[i, j1]) + u * ((1 - v) * a[i1, j] + v * a[i1, j1])


def flow(before: np.ndarray, after: np.ndarray, levels: int = 3, window: int = 15, rounds: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Dense motion down and to the right, in pixels, by least squares over windows, from coarse to fine."""
    pyramid = [(before.astype(float), after.astype(float))]
    while len(pyramid) <= levels and min(pyramid[-1][0].shape) >= 2 * window:
        pyramid.append((halved(pyramid[-1][0]), halved(pyramid[-1][1])))
    dy = dx = np.zeros(pyramid[-1][0].shape)
    for a, b in reversed(pyramid):
        h, w = a.shape
        y, x = np.mgrid[:h, :w].astype(float)
        if dy.shape != a.shape:
            dy, dx = (2 * sampled(d, y / 2, x / 2) for d in (dy, dx))
        gx, gy = (g / 8 for g in gradients(np.rint(a)))
        xx, xy, yy = box(gx * gx, window) + 1.0, box(gx * gy, window), box(gy * gy, window) + 1.0
        det = xx * yy - xy * xy
        for _ in range(rounds):
            gap = a - sampled(b, y + dy, x + dx)
            ex, ey = box(gx * gap, window), box(gy * gap, window)
            dx, dy = dx + (yy * ex - xy * ey) / det, dy + (xx * ey - xy * ex) / det
    return dy, dx


def flow_figures(frames: Sequence[np.ndarray]) -> dict[str, float | bool]:
    """Mean motion, its high end, the share of moving steps, and whether the clip stands still or moves wildly."""
    grays = [luma(f) for f in frames]
    sizes = [np.hypot(*flow(a, b)) for a, b in zip(grays, grays[1:])]
    means, highs = [float(m.mean()) for m in sizes], [float(np.quantile(m, 0.95)) for m in sizes]
    mean = lambda x: float(np.mean(x)) if len(x) else 0.0
    active, energy = mean([m > FLOW_MEAN or p > FLOW_HIGH for m, p in zip(means, highs)]), mean(highs)
    still = not sizes or (active < STILL_RATIO and energy < STILL_ENERGY)
    return {"motion_score": mean(means), "visual_motion_energy": energy, "motion_active_ratio": active, "static_clip": bool(still), "over_motion_clip": bool(active > WILD_RATIO and energy > WILD_ENERGY)}


# ---- tables ---------------------------------------------------------------------------------------------


def smaller(frame: np.ndarray, width: int) -> np.ndarray:
    """The frame at most ``width`` wide, by means of areas of whole pixels."""
    step = -(-frame.shape[1] // width)
    h, w = frame.shape[0] // step * step, frame.shape[1] // step * step
    return frame if step == 1 else np.rint(frame[:h, :w].reshape(h // step, step, w // step, step, 3).mean(axis=(1, 3))).astype(np.uint8)


def _by_clip(frames: DataFrame, key: str, schema: str, figures: Callable[[list[np.ndarray]], dict], width: int) -> DataFrame:
    kind = frames.schema[key].dataType.simpleString()

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame_idx")
        clip = [smaller(np.frombuffer(p, np.uint8).reshape(h, w, 3), width) for p, h, w in zip(pdf["pixels"], pdf["height"], pdf["width"])]
        return pd.DataFrame([{key: pdf[key].iloc[0], "frames": len(clip)} | figures(clip)])

    picked = frames.select(key, "frame_idx", "height", "width", "pixels").where("pixels is not null")
    return picked.groupBy(key).applyInPandas(lambda pdf: one(pdf)[[key, "frames", *(p.split()[0] for p in schema.split(", "))]], f"{key} {kind}, frames long, {schema}")


def clip_metrics(frames: DataFrame, key: str = "path", width: int = 320) -> DataFrame:
    """``key, frames`` and all metrics of each clip of ``key, frame_idx, height, width, pixels``."""
    schema = ", ".join([*(f"{m} double" for m in METRICS), *(f"{m} long" for m in COUNTS), *(f"{m} boolean" for m in FLAGS)])
    return _by_clip(frames, key, schema, clip_figures, width)


def flow_metrics(frames: DataFrame, key: str = "path", width: int = 320) -> DataFrame:
    """``key, frames`` and the motion of each clip by optical flow."""
    schema = "motion_score double, visual_motion_energy double, motion_active_ratio double, static_clip boolean, over_motion_clip boolean"
    return _by_clip(frames, key, schema, flow_figures, width)


def rule_columns(metrics: DataFrame) -> DataFrame:
    """The metrics under the names that ``qc.rule_check`` reads."""
    names = {
        "background_flicker": "illumination_flicker_candidate", "color_shift": "true_color_shift_candidate", "rgb_step": "global_content_rgb_shift_score", "luma_step": "global_content_brightness_step",
        "bg_luma": "background_luma_flicker_score", "bg_color": "background_color_shift_score", "fg_step": "foreground_area_change_score", "contact_score": "object_motion_without_visible_contact_score",
        "motion_ratio": "object_like_motion_ratio", "contact_visible": "contact_region_visible_ratio", "robot_visible": "robot_visible_ratio",
    }
    return metrics.withColumnsRenamed({old: new for new, old in names.items()})
