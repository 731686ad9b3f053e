"""Polygon checks, masks and image hashes that need loops over points or pixels."""

from __future__ import annotations

import math

import numpy as np

Point = tuple[float, float]
#: Overflow in pixels and change of area that a clip may have.
OVERFLOW_PX, CLIP_FRACTION = 0.5, 0.001


def shoelace(points: list[Point]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1])) / 2


def _side(a: Point, b: Point, c: Point) -> float:
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def _on(a: Point, b: Point, c: Point) -> bool:
    return min(a[0], b[0]) <= c[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= c[1] <= max(a[1], b[1])


def _meet(a: Point, b: Point, c: Point, d: Point) -> bool:
    s = _side(a, b, c), _side(a, b, d), _side(c, d, a), _side(c, d, b)
    if s[0] * s[1] < 0 and s[2] * s[3] < 0:
        return True
    return any(v == 0 and _on(*seg) for v, seg in zip(s, ((a, b, c), (a, b, d), (c, d, a), (c, d, b))))


def simple(points: list[Point]) -> bool:
    """Whether no two edges of a ring meet but neighbours in their common point."""
    n = len(points)
    edges = [(points[i], points[(i + 1) % n]) for i in range(n)]
    for i in range(n):
        for j in range(i + 1, n):
            if j == i + 1 or (i == 0 and j == n - 1):
                (a, b), (c, d) = (edges[i], edges[j]) if j == i + 1 else (edges[j], edges[i])
                if _side(a, b, d) == 0 and (_on(a, b, d) or _on(c, d, a)):
                    return False  # folds back over itself
            elif _meet(*edges[i], *edges[j]):
                return False
    return True


def clipped(points: list[Point], width: float, height: float) -> list[Point]:
    """The ring inside the box from the origin, one side after another."""
    for axis, limit, sign in ((0, 0.0, 1), (0, float(width), -1), (1, 0.0, 1), (1, float(height), -1)):
        inside = lambda p: sign * (p[axis] - limit) >= 0  # noqa: E731, B023
        out: list[Point] = []
        for a, b in zip(points[-1:] + points[:-1], points):
            if inside(a) != inside(b):
                t = (limit - a[axis]) / (b[axis] - a[axis])
                cut = [a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])]
                cut[axis] = limit
                out.append(tuple(cut))
            if inside(b):
                out.append(b)
        points = [p for p, q in zip(out, out[-1:] + out[:-1]) if p != q]
    return points


def training_polygon(points: list | None, width: float | None, height: float | None) -> tuple[list[Point] | None, str, list[str]]:
    """(polygon, status, flags): the first check that fails sends it to review."""
    flags: set[str] = set()
    review = lambda flag: (None, "review_required", sorted(flags | {flag}))
    ring: list[Point] = []
    for p in points or []:
        if p is None or len(p) != 2 or any(v is None or not math.isfinite(v) for v in p):
            return review("non_finite_or_malformed_point")
        if ring and tuple(p) == ring[-1]:
            flags.add("removed_consecutive_duplicate_vertex")
        else:
            ring.append((float(p[0]), float(p[1])))
    if len(ring) > 1 and ring[0] == ring[-1]:
        ring.pop()
        flags.add("removed_duplicate_closing_vertex")
    if len(set(ring)) < 3:
        return review("fewer_than_three_unique_vertices")
    size = abs(shoelace(ring))
    if size <= 0:
        return review("zero_area_polygon")
    if not simple(ring):
        return review("self_intersection_or_invalid_topology")
    if width is None or height is None:
        return review("missing_image_dimensions")
    xs, ys = zip(*ring)
    over = max(0.0, -min(xs), -min(ys), max(xs) - width, max(ys) - height)
    if over > OVERFLOW_PX:
        return review("polygon_out_of_bounds")
    if over > 0:
        inside = clipped(ring, width, height)
        if len(inside) < 3 or not simple(inside):
            return review("boundary_clip_not_single_polygon")
        if abs(size - abs(shoelace(inside))) / size > CLIP_FRACTION:
            return review("boundary_clip_area_change_too_large")
        ring = inside
        flags.add("clipped_subpixel_boundary_overflow")
    return ring, "accepted", sorted(flags)


def mask(points: list[Point], left: int, top: int, right: int, bottom: int) -> np.ndarray:
    """Which pixels of a window have their centre inside the ring."""
    x = np.arange(left, right) + 0.5
    y = np.arange(top, bottom)[:, None] + 0.5
    out = np.zeros((max(0, bottom - top), max(0, right - left)), bool)
    for (x0, y0), (x1, y1) in zip(points, points[1:] + points[:1]):
        if y0 != y1:
            out ^= ((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
    return out


def mask_iou(a: list[Point], b: list[Point], width: int, height: int) -> float:
    """Intersection over union of two rings' pixels inside the image."""
    xs, ys = zip(*a, *b)
    window = max(0, math.floor(min(xs))), max(0, math.floor(min(ys))), min(width, math.ceil(max(xs))), min(height, math.ceil(max(ys)))
    one, two = mask(a, *window), mask(b, *window)
    union = int((one | two).sum())
    return int((one & two).sum()) / union if union else 0.0


def _resized(pixels: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """Means of the cells of a grid over the image."""
    for axis, n in ((0, rows), (1, columns)):
        m = pixels.shape[axis]
        at = np.arange(n + 1) * m / n
        total = np.concatenate([np.zeros_like(pixels.take([0], axis)), np.cumsum(pixels, axis)], axis)
        whole = np.minimum(np.floor(at).astype(int), m - 1)
        shape = [-1 if i == axis else 1 for i in range(2)]
        upto = total.take(whole, axis) + (at - whole).reshape(shape) * pixels.take(whole, axis)
        pixels = np.diff(upto, axis=axis) * n / m
    return pixels


def perceptual_hashes(pixels: np.ndarray) -> tuple[int, int]:
    """(pHash, dHash) of a grey image: the signs of its 8 by 8 lowest frequencies about
    their median (the constant one has a bit, but no part in the median), and which of
    nine cells in each of eight rows is brighter than its right neighbour."""
    grey = np.asarray(pixels, np.float64)
    small = _resized(grey, 32, 32)
    k, i = np.arange(8)[:, None], np.arange(32)[None, :]
    basis = np.cos(np.pi * (2 * i + 1) * k / 64) * np.where(k == 0, np.sqrt(1 / 32), np.sqrt(2 / 32))
    low = (basis @ small @ basis.T).ravel()
    row = _resized(grey, 8, 9)
    bits = lambda b: int("".join("1" if x else "0" for x in b), 2)
    return bits(low > np.median(low[1:])), bits((row[:, :-1] > row[:, 1:]).ravel())
