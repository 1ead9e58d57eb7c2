"""Measures of grey rasters in NumPy, for use inside tasks: brightness, histogram, entropy, Laplacian variance, structural similarity, motion of blocks.

A raster is a 2-D array of bytes. Everything works on arrays as a whole; nothing here needs Spark or an image library.
"""

from __future__ import annotations

import numpy as np

#: Window and constants of structural similarity; sizes to which rasters are shrunk for it and for motion.
WINDOW, K1, K2, RANGE = 7, 0.01, 0.03, 255.0
THUMB, GRID = (256, 256), (60, 80)
#: Motion is given in pixels of a frame of this width; blocks are looked for at most RADIUS grid points away.
MOTION_WIDTH, BLOCK, RADIUS = 320, 8, 8


def of_bytes(data: bytes | None, height: int | None, width: int | None) -> np.ndarray | None:
    """The raster of these bytes, row by row; None where they are missing or don't fit."""
    if not data or not height or not width or height < 1 or width < 1 or len(data) != height * width:
        return None
    return np.frombuffer(data, dtype=np.uint8).reshape(height, width)


def histogram(r: np.ndarray) -> np.ndarray:
    return np.bincount(r.reshape(-1), minlength=256)


def entropy(counts: np.ndarray) -> float:
    """Bits of a histogram's distribution."""
    p = counts[counts > 0] / counts.sum()
    return float(-(p * np.log2(p)).sum()) + 0.0


def laplacian_variance(r: np.ndarray) -> float:
    """Variance of each pixel's four neighbours less four times itself; beyond an edge the raster is mirrored at it."""
    f = np.pad(r.astype(np.float64), [(1, 1) if n > 1 else (0, 0) for n in r.shape], mode="reflect")
    f = np.pad(f, [(0, 0) if n > 1 else (1, 1) for n in r.shape], mode="edge")
    return float((f[:-2, 1:-1] + f[2:, 1:-1] + f[1:-1, :-2] + f[1:-1, 2:] - 4 * f[1:-1, 1:-1]).var())


def shrunk(r: np.ndarray, most: tuple[int, int]) -> np.ndarray:
    """The raster at no more than this height and width: each new pixel is the mean of the area that it covers."""
    out = r
    for axis, size in enumerate(most):
        n = out.shape[axis]
        if n > size:
            # running sums at fractional places: the share of a pixel that an area cuts counts
            sums = np.concatenate([np.zeros_like(out.take([0], axis), dtype=np.float64), np.cumsum(out, axis=axis, dtype=np.float64)], axis=axis)
            at = np.arange(size + 1) * (n / size)
            low = np.minimum(at.astype(int), n - 1)
            share = (at - low).reshape([-1 if a == axis else 1 for a in range(2)])
            edge = sums.take(low, axis) * (1 - share) + sums.take(low + 1, axis) * share
            out = np.diff(edge, axis=axis) * (size / n)
    return out if out is r else np.clip(np.rint(out), 0, 255).astype(np.uint8)


def resized(r: np.ndarray, to: tuple[int, int]) -> np.ndarray:
    """The raster at this height and width, between the four nearest pixels' centres; bytes are rounded."""
    out = r.astype(np.float64)
    for axis, size in enumerate(to):
        n = out.shape[axis]
        at = np.clip((np.arange(size) + 0.5) * n / size - 0.5, 0, n - 1)
        low = np.minimum(at.astype(int), max(n - 2, 0))
        share = (at - low).reshape([-1 if a == axis else 1 for a in range(2)])
        out = out.take(low, axis) * (1 - share) + out.take(np.minimum(low + 1, n - 1), axis) * share
    return np.rint(out).astype(np.uint8) if r.dtype == np.uint8 else out.astype(r.dtype)


def window_means(f: np.ndarray) -> np.ndarray:
    """Mean of each whole window, by an integral image."""
    s = np.pad(f, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
    k = WINDOW
    return (s[k:, k:] - s[:-k, k:] - s[k:, :-k] + s[:-k, :-k]) / (k * k)


def correlation(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised cross-correlation, clipped to [0, 1]."""
    x, y = ((v - v.mean()) / max(v.std(), 1e-8) for v in (a.astype(np.float64), b.astype(np.float64)))
    return float(np.clip((x * y).mean(), 0.0, 1.0))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Mean structural similarity over all whole windows, with sample covariance; rasters too small for one window are correlated. Rasters of different shape are not alike: 0."""
    if a.shape != b.shape:
        return 0.0
    if min(a.shape) < WINDOW:
        return correlation(a, b)
    x, y = a.astype(np.float64), b.astype(np.float64)
    n = WINDOW * WINDOW
    mx, my = window_means(x), window_means(y)
    vx, vy, vxy = (window_means(p) - m for p, m in ((x * x, mx * mx), (y * y, my * my), (x * y, mx * my)))
    vx, vy, vxy = (v * (n / (n - 1)) for v in (vx, vy, vxy))
    c1, c2 = (K1 * RANGE) ** 2, (K2 * RANGE) ** 2
    return float(((2 * mx * my + c1) * (2 * vxy + c2) / ((mx * mx + my * my + c1) * (vx + vy + c2))).mean())


def motion(before: np.ndarray, now: np.ndarray, width: int) -> float:
    """Mean distance that blocks of `before` have moved to in `now`, both shrunk from a frame of `width`, in pixels of a frame MOTION_WIDTH wide.

    Every place within RADIUS is tried for every block; of equally good ones the nearest counts. Beyond an edge the raster goes on as at it. 0 for different shapes.
    """
    if before.shape != now.shape:
        return 0.0
    h, w = now.shape
    size = max(1, min(BLOCK, min(h, w) // 4))
    rows, cols = h // size, w // size
    a = before[: rows * size, : cols * size].astype(np.int16)
    b = np.pad(now, RADIUS, mode="edge").astype(np.int16)
    shifts = sorted(((dy, dx) for dy in range(-RADIUS, RADIUS + 1) for dx in range(-RADIUS, RADIUS + 1)), key=lambda s: (s[0] ** 2 + s[1] ** 2, s))
    best, far = np.full((rows, cols), np.iinfo(np.int64).max), np.zeros((rows, cols))
    for dy, dx in shifts:
        off = np.abs(a - b[RADIUS + dy : RADIUS + dy + rows * size, RADIUS + dx : RADIUS + dx + cols * size]).reshape(rows, size, cols, size).sum((1, 3), dtype=np.int64)
        better = off < best
        best[better], far[better] = off[better], np.hypot(dy, dx)
    return float(far.mean()) * MOTION_WIDTH / w
