"""Which rings cross or touch themselves, for many rings at once, on numpy arrays inside a task.

The edges of a ring are dealt to the cells of a grid of its own, about as wide and high as its edges are on
average, so that each edge comes to few cells. Cells that still hold many edges get a grid of their own again;
in the others all pairs meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

FEW = 12  # edges of a cell that meet pair by pair
SPREAD = 12  # times the edges: more than that isn't dealt out, the cells meet pair by pair as they are
CHUNK = 200_000  # edges whose rings are looked at together; a larger ring comes by itself
_SLIVER = 1e-9  # of a cell, and ...
_ULPS = 1e-14  # ... of the largest coordinate: how far beyond its own cells an edge is dealt


def touch(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``segments_touch`` of edges ``(px, py, qx, qy)``, column by column."""
    (px, py, qx, qy), (rx, ry, sx, sy) = a, b
    near = (np.maximum(px, qx) >= np.minimum(rx, sx)) & (np.maximum(rx, sx) >= np.minimum(px, qx))
    near &= (np.maximum(py, qy) >= np.minimum(ry, sy)) & (np.maximum(ry, sy) >= np.minimum(py, qy))
    side = lambda ax, ay, bx, by, cx, cy: np.sign((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))
    return (near & (side(px, py, qx, qy, rx, ry) * side(px, py, qx, qy, sx, sy) <= 0)
            & (side(rx, ry, sx, sy, px, py) * side(rx, ry, sx, sy, qx, qy) <= 0))


def _cross(edges: np.ndarray, ring: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Numbers of the rings of which two edges that aren't neighbours touch. An edge has its ring, its place
    there and the ring's number of edges."""
    hit = np.zeros(ring.max(initial=-1) + 1, bool)
    low, high = np.minimum(edges[:2], edges[2:]), np.maximum(edges[:2], edges[2:])
    most = np.abs(edges).max(initial=0.0)

    def meet(e: np.ndarray, cell: np.ndarray) -> None:
        """All pairs of a cell's edges; ``cell`` is sorted."""
        left = np.arange(len(e))
        for d in range(1, len(e)):
            left = left[: np.searchsorted(left, len(e) - d)]
            left = left[cell[left] == cell[left + d]]
            left = left[~hit[ring[e[left]]]]
            if not len(left):
                return
            a, b = e[left], e[left + d]
            i, j = np.minimum(at[a], at[b]), np.maximum(at[a], at[b])
            apart = (j > i + 1) & ~((i == 0) & (j == count[a] - 1))
            a, b = a[apart], b[apart]
            hit[ring[a[touch(edges[:, a], edges[:, b])]]] = True

    def spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows repeated for each whole number from ``first`` to ``last``, with that number."""
        n = np.maximum(last - first + 1, 0)
        rows = np.repeat(np.arange(len(n)), n)
        return rows, first[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)

    # Each row is an edge in a cell; at first a ring is one cell.
    e, cell = np.arange(len(ring)), np.unique(ring, return_inverse=True)[1]
    size = np.bincount(cell)
    box = np.stack([np.full(len(size), v) for v in (np.inf, np.inf, -np.inf, -np.inf)])
    for k in (0, 1):
        np.minimum.at(box[k], cell, low[k])
        np.maximum.at(box[k + 2], cell, high[k])
    fresh = np.ones(len(size), bool)  # cells that may be dealt out further
    while len(e):
        few = (size <= FEW) | ~fresh
        done = few[cell]
        meet(e[done], cell[done])
        open_ = ~done & ~hit[ring[e]]
        if not open_.any():
            break
        e, cell = e[open_], cell[open_]
        kept, cell = np.unique(cell, return_inverse=True)
        size, box = np.bincount(cell), box[:, kept]
        # Cells as wide and high as the edges are, on average, inside what is dealt out.
        part = [np.maximum(np.minimum(high[k][e], box[k + 2][cell]) - np.maximum(low[k][e], box[k][cell]), 0.0) for k in (0, 1)]
        wide = [box[k + 2] - box[k] for k in (0, 1)]
        n = [np.floor(np.clip(wide[k] / np.maximum(np.maximum(np.bincount(cell, part[k]) / size, wide[k] / size), 1e-300), 1, None)).astype(np.int64) for k in (0, 1)]
        flat = (n[0] == 1) & (n[1] == 1)  # edges as long as the cell: halve it
        n = [np.where(flat & (wide[k] > 0), 2, n[k]) for k in (0, 1)]
        step = [wide[k] / n[k] for k in (0, 1)]
        slack = [_SLIVER * step[k] + _ULPS * most for k in (0, 1)]
        fine = [np.where(step[k] > 0, step[k], 1.0) for k in (0, 1)]

        def index(k: int, of: np.ndarray, v: np.ndarray, by: int) -> np.ndarray:
            return np.clip(np.floor((v - box[k][of] + by * slack[k][of]) / fine[k][of]), 0, n[k][of] - 1).astype(np.int64)  # noqa: B023

        rows, cx = spread(index(0, cell, low[0][e], -1), index(0, cell, high[0][e], 1))
        f, of = e[rows], cell[rows]
        left = box[0][of] + cx * step[0][of]
        # Of a slanting edge, only the stretch that lies in the column.
        px, py, qx, qy = edges[:, f]
        run = np.where(px == qx, 1.0, qx - px)
        ends = [py + (qy - py) * ((np.clip(x, low[0][f], high[0][f]) - px) / run) for x in (left - slack[0][of], left + step[0][of] + slack[0][of])]
        bottom = np.where(px == qx, low[1][f], np.minimum(*ends))
        top = np.where(px == qx, high[1][f], np.maximum(*ends))
        inside = (top >= box[1][of] - 2 * slack[1][of]) & (bottom <= box[3][of] + 2 * slack[1][of])
        f, of, cx, bottom, top = f[inside], of[inside], cx[inside], bottom[inside], top[inside]
        rows, cy = spread(index(1, of, bottom, -1), index(1, of, top, 1))
        f, of, cx = f[rows], of[rows], cx[rows]
        first = np.cumsum(n[0] * n[1]) - n[0] * n[1]
        key = first[of] + cx * n[1][of] + cy
        order = np.argsort(key, kind="stable")
        f, of, cx, cy, key = f[order], of[order], cx[order], cy[order], key[order]
        _, start, new = np.unique(key, return_index=True, return_inverse=True)
        parent, ix, iy = of[start], cx[start], cy[start]
        before, size = size, np.bincount(new)
        # A grid that hardly parts the edges, or cells near the last bits of the coordinates, end it.
        least = np.minimum(*(np.where(step[k] > 0, step[k], np.inf) for k in (0, 1)))
        small = least[parent] < 1e3 * _ULPS * most
        fresh = (size < 0.9 * before[parent]) & ~small & (len(f) <= SPREAD * len(ring))
        x0, y0 = box[0][parent] + ix * step[0][parent], box[1][parent] + iy * step[1][parent]
        box = np.stack([x0, y0, x0 + step[0][parent], y0 + step[1][parent]])
        e, cell = f, new
    return np.flatnonzero(hit)


def crossed(rings: pa.Array) -> np.ndarray:
    """Of each row of ``list<list<struct<x, y>>>``, whether a ring crosses or touches itself."""
    rings = rings.combine_chunks() if isinstance(rings, pa.ChunkedArray) else rings
    row_of = rings.value_parent_indices().to_numpy() if len(rings) else np.zeros(0, np.int64)
    lists = rings.flatten()
    ring_of = lists.value_parent_indices().to_numpy()
    points = lists.flatten()
    x, y = (c.to_numpy(zero_copy_only=False).astype(np.float64) for c in points.flatten())
    out = np.zeros(len(rings), bool)
    # Edges run between neighbours of the same ring.
    start = np.flatnonzero(ring_of[1:] == ring_of[:-1])
    ring = ring_of[start]
    count = np.bincount(ring, minlength=len(lists))
    at = np.arange(len(ring)) - (np.cumsum(count) - count)[ring]
    edges = np.stack([x[start], y[start], x[start + 1], y[start + 1]])
    ok = np.isfinite(edges).all(axis=0) & (count[ring] > 1)
    edges, ring, at, n = edges[:, ok], ring[ok], at[ok], count[ring[ok]]
    i = 0
    while i < len(ring):
        j = i + CHUNK
        j = len(ring) if j >= len(ring) else max(np.searchsorted(ring, ring[j]), np.searchsorted(ring, ring[i], "right"))
        out[row_of[ring[i] + _cross(edges[:, i:j], ring[i:j] - ring[i], at[i:j], n[i:j])]] = True
        i = j
    return out
