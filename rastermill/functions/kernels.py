"""Numpy kernels over pixel grids; polygons are lists of rings of (x, y) in pixel units, the first the exterior."""

from __future__ import annotations

import logging

import numpy as np

log = logging.getLogger(__name__)
Ring = np.ndarray
Polygon = list[Ring]


def polygon_mask(polygon: Polygon, width: int, height: int, x0: int = 0, y0: int = 0) -> np.ndarray:
    """Pixels whose centre lies inside, by crossings to the left of each centre (holes by parity)."""
    flips = np.zeros((height, width + 1), np.int32)
    for ring in polygon:
        pts = np.asarray(ring, float)
        if len(pts) and not np.array_equal(pts[0], pts[-1]):
            pts = np.vstack([pts, pts[:1]])
        a, b = pts[:-1] - (x0, y0), pts[1:] - (x0, y0)
        for (ax, ay), (bx, by) in zip(a, b, strict=True):
            if ay == by:
                continue
            lo, hi = min(ay, by), max(ay, by)
            rows = np.arange(max(0, int(np.ceil(lo - 0.5))), min(height, int(np.ceil(hi - 0.5))))
            at = ax + (rows + 0.5 - ay) / (by - ay) * (bx - ax)
            first = np.clip(np.ceil(at - 0.5), 0, width).astype(int)  # first centre at or right of the crossing
            np.add.at(flips, (rows, first), 1)
    return np.cumsum(flips, axis=1)[:, :width] % 2 == 1


def bounds(polygon: Polygon) -> tuple[float, float, float, float]:
    pts = np.asarray(polygon[0], float)
    return (*pts.min(axis=0), *pts.max(axis=0))


def area(ring: Ring) -> float:
    x, y = np.asarray(ring, float).T
    return abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2


def distance(mask: np.ndarray, limit: float | None = None) -> np.ndarray:
    """Exact Euclidean distance of each set pixel to the nearest unset one; 0 where unset.

    Column distances first, then for each horizontal offset a running minimum; it ends as soon as the offset
    alone is no improvement anywhere. A mask without an unset pixel gives zeros. Distances above `limit` may be larger than exact.
    """
    if mask.all():
        if mask.size:
            log.warning("distance of a mask without background is taken as 0")
        return np.zeros(mask.shape)
    h, w = mask.shape
    far = float(h + w + 1)
    col = np.where(mask, far, 0.0)
    for y in range(1, h):
        np.minimum(col[y], col[y - 1] + 1, out=col[y])
    for y in range(h - 2, -1, -1):
        np.minimum(col[y], col[y + 1] + 1, out=col[y])
    base = col * col
    best = base.copy()
    for k in range(1, w):
        if k * k >= (best.max() if limit is None else min(best.max(), limit * limit)):
            break
        np.minimum(best[:, k:], base[:, :-k] + k * k, out=best[:, k:])
        np.minimum(best[:, :-k], base[:, k:] + k * k, out=best[:, :-k])
    return np.sqrt(best)


def to_byte(x: np.ndarray) -> np.ndarray:
    """Values of [0, 1] as 0 to 255, cut to whole numbers."""
    return np.clip(x * 255, 0, 255).astype(np.uint8)


def two_nearest(polygons: list[Polygon], width: int, height: int, reach: float, x0: int = 0, y0: int = 0, image: tuple[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distances to the nearest and second nearest polygon, at most reach, over a tile at (x0, y0) of an image (width, height).

    What a polygon has outside the image does not count.
    """
    full = image or (x0 + width, y0 + height)
    near = np.full((height, width), float(reach))
    second = near.copy()
    pad = int(reach) + 1
    for p in polygons:
        minx, miny, maxx, maxy = bounds(p)
        c0, r0 = max(0, int(np.floor(minx)) - pad), max(0, int(np.floor(miny)) - pad)
        c1, r1 = min(full[0], int(np.ceil(maxx)) + pad + 1), min(full[1], int(np.ceil(maxy)) + pad + 1)
        if c0 >= c1 or r0 >= r1:
            continue
        mask = polygon_mask(p, c1 - c0, r1 - r0, c0, r0)
        if not mask.any():
            continue
        d = distance(~mask, reach)
        a, b = max(c0, x0), min(c1, x0 + width)
        u, v = max(r0, y0), min(r1, y0 + height)
        if a >= b or u >= v:
            continue
        d = d[u - r0 : v - r0, a - c0 : b - c0]
        n, s = near[u - y0 : v - y0, a - x0 : b - x0], second[u - y0 : v - y0, a - x0 : b - x0]
        np.copyto(s, np.where(d < n, n, np.minimum(s, d)))
        np.minimum(n, d, out=n)
    return near, second


def dual_weight(near: np.ndarray, second: np.ndarray, reach: float, sigma: float = 3.0) -> np.ndarray:
    """exp(-(d1 + d2) / sigma) where both are within reach, else 0."""
    return np.where((near < reach) & (second < reach), np.exp(-(near + second) / sigma), 0.0)


def splat(points: np.ndarray, width: int, height: int, sigma: float, radius: int) -> np.ndarray:
    """Sum of Gaussian stencils at points, at most 1."""
    out = np.zeros(height * width)
    if len(points) and width > 2 * radius and height > 2 * radius:
        centre = np.clip(points.astype(int), radius, np.array([width, height]) - radius - 1)
        off = np.stack(np.meshgrid(np.arange(-radius, radius + 1), np.arange(-radius, radius + 1)), axis=-1).reshape(-1, 2)
        at = centre[:, None, :] + off
        w = np.exp(-((at - points[:, None, :]) ** 2).sum(axis=2) / (2 * sigma * sigma))
        out += np.bincount((at[..., 1] * width + at[..., 0]).ravel(), w.ravel(), height * width)
    return np.minimum(out.reshape(height, width), 1.0)


def boundary_points(polygons: list[Polygon]) -> np.ndarray:
    """Two points for each pixel of exterior edge length, ends included."""
    found = [np.empty((0, 2))]
    for p in polygons:
        pts = np.asarray(p[0], float)
        pts = pts if np.array_equal(pts[0], pts[-1]) else np.vstack([pts, pts[:1]])
        for a, b in zip(pts[:-1], pts[1:], strict=True):
            n = max(int(np.hypot(*(b - a)) * 2), 1)
            found.append(a + np.linspace(0, 1, n)[:, None] * (b - a))
    return np.vstack(found)


def boundary_map(polygons: list[Polygon], width: int, height: int) -> np.ndarray:
    return splat(boundary_points(polygons), width, height, 0.8, 2)


def vertex_points(polygons: list[Polygon]) -> np.ndarray:
    """Exterior vertices, each once."""
    found = [np.empty((0, 2))]
    for p in polygons:
        pts = np.asarray(p[0], float)
        found.append(pts[:-1] if len(pts) > 1 and np.array_equal(pts[0], pts[-1]) else pts)
    return np.vstack(found)


def vertex_map(polygons: list[Polygon], width: int, height: int) -> np.ndarray:
    return splat(vertex_points(polygons), width, height, 1.5, 5)


def union_mask(polygons: list[Polygon], width: int, height: int) -> np.ndarray:
    out = np.zeros((height, width), bool)
    for p in polygons:
        out |= polygon_mask(p, width, height)
    return out


def signed_distance(mask: np.ndarray) -> np.ndarray:
    """Distance to the other side, positive inside, divided by its largest size (at least 1)."""
    if not mask.any():
        return np.zeros(mask.shape)
    field = np.where(mask, distance(mask), -distance(~mask))
    return field / max(np.abs(field).max(), 1.0)


def road_weight(polygons: list[Polygon], width: int, height: int) -> np.ndarray:
    """Largest inside distance of the polygons at each pixel, divided by the image's largest."""
    out = np.zeros((height, width))
    for p in polygons:
        minx, miny, maxx, maxy = bounds(p)
        c0, r0 = max(0, int(minx) - 1), max(0, int(miny) - 1)
        c1, r1 = min(width, int(maxx) + 2), min(height, int(maxy) + 2)
        if c0 >= c1 or r0 >= r1:
            continue
        mask = polygon_mask(p, c1 - c0, r1 - r0, c0, r0)
        if mask.any():
            np.maximum(out[r0:r1, c0:c1], distance(mask), out=out[r0:r1, c0:c1])
    return out / out.max() if out.max() > 0 else out


def rasterize(polygons: list[Polygon], values: list[int], width: int, height: int) -> np.ndarray:
    """Burned values; the largest is on top."""
    out = np.zeros((height, width), np.int64)
    for p, v in sorted(zip(polygons, values, strict=True), key=lambda t: t[1]):
        out[polygon_mask(p, width, height)] = v
    return out


def clip_ring(ring: Ring, minx: float, miny: float, maxx: float, maxy: float) -> Ring:
    """A ring cut by a rectangle, side by side; empty if nothing is left."""
    pts = [tuple(map(float, q)) for q in ring]
    if pts and pts[0] == pts[-1]:
        pts = pts[:-1]
    for axis, bound, keep in ((0, minx, 1), (0, maxx, -1), (1, miny, 1), (1, maxy, -1)):
        out = []
        for k, q in enumerate(pts):
            before = pts[k - 1]
            inside, was = (q[axis] - bound) * keep >= 0, (before[axis] - bound) * keep >= 0
            if inside != was:
                t = (bound - before[axis]) / (q[axis] - before[axis])
                cut = [before[i] + t * (q[i] - before[i]) for i in (0, 1)]
                cut[axis] = bound
                out.append(tuple(cut))
            if inside:
                out.append(q)
        pts = out
        if not pts:
            break
    return np.array([*pts, pts[0]]) if len(pts) >= 3 else np.empty((0, 2))


def shrink_convex(ring: Ring, by: float) -> Ring | None:
    """A convex ring moved inwards by a distance: empty if nothing is left, null if the ring is not convex."""
    pts = np.asarray(ring, float)
    pts = pts[:-1] if len(pts) > 1 and np.array_equal(pts[0], pts[-1]) else pts
    edge = np.roll(pts, -1, axis=0) - pts
    turn = edge[:, 0] * np.roll(edge, -1, axis=0)[:, 1] - edge[:, 1] * np.roll(edge, -1, axis=0)[:, 0]
    if (turn > 0).any() and (turn < 0).any():
        return None
    side = 1.0 if turn.sum() >= 0 else -1.0
    out = [tuple(q) for q in pts]
    for p, e in zip(pts, edge, strict=True):
        length = np.hypot(*e)
        if length == 0:
            continue
        normal = side * np.array([-e[1], e[0]]) / length
        depth = [float(np.dot(np.array(q) - p, normal)) - by for q in out]
        cut = []
        for k, q in enumerate(out):
            if (depth[k] >= 0) != (depth[k - 1] >= 0):
                t = depth[k - 1] / (depth[k - 1] - depth[k])
                cut.append(tuple(np.array(out[k - 1]) + t * (np.array(q) - np.array(out[k - 1]))))
            if depth[k] >= 0:
                cut.append(q)
        out = cut
        if not out:
            return np.empty((0, 2))
    return np.array([*out, out[0]])


def eroded(polygon: Polygon, by: float, min_area: float = 4.0, min_width: float = 1.5) -> Polygon:
    """The polygon shrunk by a distance, or itself where it would get too small or is not convex or has holes."""
    if by <= 0 or len(polygon) > 1 or area(polygon[0]) < 3 * min_area:
        return polygon
    ring = shrink_convex(polygon[0], by)
    if ring is None or len(ring) < 4 or area(ring) < min_area or (ring.max(axis=0) - ring.min(axis=0)).min() < min_width:
        return polygon
    return [ring]


def self_intersects(ring: Ring) -> bool:
    """Whether two edges that are not neighbours cross or touch."""
    pts = np.asarray(ring, float)
    pts = pts if len(pts) > 1 and np.array_equal(pts[0], pts[-1]) else np.vstack([pts, pts[:1]])
    a, b = pts[:-1], pts[1:]
    n = len(a)
    side = lambda p, q, r: (q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0])
    for i in range(n - 2):
        j = np.arange(i + 2, n - (i == 0))
        if not len(j):
            continue
        d1, d2 = side(a[i], b[i], a[j]), side(a[i], b[i], b[j])
        d3, d4 = side(a[j], b[j], a[i]), side(a[j], b[j], b[i])
        if ((d1 * d2 < 0) & (d3 * d4 < 0)).any():
            return True
    return False
