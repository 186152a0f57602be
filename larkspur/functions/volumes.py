"""Tensor steps on one volume, in numpy, and the frame function that applies a chain of them row by row.

A volume row is ``shape``, ``spacing`` and one binary of float32 voxels; batches hold few rows
because one row can be hundreds of megabytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def rescale(x: np.ndarray, slope: float, intercept: float) -> np.ndarray:
    """N1."""
    return x * np.float32(slope) + np.float32(intercept)


def clip(x: np.ndarray, low: float = -1000, high: float = 1000) -> np.ndarray:
    """N2."""
    return np.clip(x, low, high)


def scale(x: np.ndarray, low: float, high: float, centre: bool = False) -> np.ndarray:
    """[low, high] to [0, 1], or to [-1, 1]."""
    y = (x - low) / (high - low)
    return y * 2 - 1 if centre else y


def window(x: np.ndarray, low: float, high: float) -> np.ndarray:
    """A viewer window to [0, 1]."""
    return (np.clip(x, low, high) - low) / (high - low)


def resize(x: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """Linear along each axis, sample centres aligned (not corners)."""
    out = x.astype(np.float32)
    for axis, n in enumerate(shape):
        m = out.shape[axis]
        if m == n:
            continue
        at = np.clip((np.arange(n) + 0.5) * m / n - 0.5, 0, m - 1)
        a = np.floor(at).astype(int)
        b, f = np.minimum(a + 1, m - 1), (at - a).astype(np.float32)
        f = f.reshape([-1 if i == axis else 1 for i in range(out.ndim)])
        out = np.take(out, a, axis) * (1 - f) + np.take(out, b, axis) * f
    return out


def resample(x: np.ndarray, spacing: tuple[float, ...], target: tuple[float, ...], rounding: str = "round") -> np.ndarray:
    """To a new spacing; ``rounding`` is ``round`` (1 at least) or ``int``."""
    sizes = [n * s / t for n, s, t in zip(x.shape, spacing, target, strict=True)]
    return resize(x, tuple(max(1, round(v)) if rounding == "round" else int(v) for v in sizes))


def centre_fit(x: np.ndarray, shape: tuple[int, ...], fill: float | None = -1.0) -> np.ndarray:
    """Centre crop, then centre pad; ``fill`` None pads with the volume's minimum."""
    for axis, n in enumerate(shape):
        m = x.shape[axis]
        if m > n:
            start = (m - n) // 2
            x = np.take(x, range(start, start + n), axis)
    pads = [((n - m) // 2, n - m - (n - m) // 2) for m, n in zip(x.shape, shape, strict=True)]
    return np.pad(x, pads, constant_values=x.min() if fill is None else fill)


def end_fit(x: np.ndarray, shape: tuple[int, ...], fill: float = 0.0) -> np.ndarray:
    """Cut and padded at the end of each axis only."""
    x = x[tuple(slice(0, n) for n in shape)]
    return np.pad(x, [(0, n - m) for m, n in zip(x.shape, shape, strict=True)], constant_values=fill)


def slice_triples(x: np.ndarray) -> np.ndarray:
    """Groups of three slices as channels; a rest is dropped."""
    n = len(x) // 3
    return x[: n * 3].reshape(n, 3, *x.shape[1:])


def augment(x: np.ndarray, seed: int) -> np.ndarray:
    """Seeded flips and quarter turns in the slice plane."""
    rng = np.random.default_rng(seed)
    for axis in (1, 2):
        if rng.random() < 0.5:
            x = np.flip(x, axis)
    return np.rot90(x, int(rng.integers(4)), (1, 2))


def median3(x: np.ndarray) -> np.ndarray:
    """3 x 3 x 3 median, edges mirrored."""
    p = np.pad(x, 1, mode="symmetric")
    return np.median(np.lib.stride_tricks.sliding_window_view(p, (3, 3, 3)).reshape(*x.shape, 27), axis=-1)


def standard(x: np.ndarray, spacing: tuple[float, ...], shape: tuple[int, ...] = (512, 512, 512)) -> np.ndarray:
    """1 mm, padded and cropped at the centre, clipped, scaled."""
    return scale(clip(centre_fit(resample(x, spacing, (1.0,) * x.ndim), shape, None)), -1000, 1000)


def full_slices(x: np.ndarray, least: float) -> np.ndarray:
    """Slices whose maximum reaches ``least``."""
    return x[x.reshape(len(x), -1).max(axis=1) >= least]


def min_max(x: np.ndarray) -> np.ndarray:
    """N15."""
    low, high = x.min(), x.max()
    return np.zeros_like(x) if high == low else (x - low) / (high - low)


def z_score(x: np.ndarray) -> np.ndarray:
    """N15, variant."""
    sd = x.std()
    return x - x.mean() if sd == 0 else (x - x.mean()) / sd


def spatial_mean(x: np.ndarray) -> np.ndarray:
    """Mean over all axes but the first."""
    return x.reshape(len(x), -1).mean(axis=1)


def planes(x: np.ndarray, ratio: float = 1.0, step: int = 1) -> Iterator[tuple[str, int, np.ndarray]]:
    """(plane, index, slice) of the middle ``ratio`` of each axis."""
    for axis, name in enumerate(("xy", "xz", "yz")):
        n = x.shape[axis]
        for i in range(int((1 - ratio) / 2 * n), int((1 + ratio) / 2 * n), step):
            yield name, i, np.take(x, i, axis)


def cast_frames(x: np.ndarray, frames: int) -> np.ndarray:
    """Cut or padded with zeros to ``frames`` slices."""
    return end_fit(x, (frames, *x.shape[1:]))


def as_rgb(x: np.ndarray) -> np.ndarray:
    """[0, 1] to bytes in three equal channels."""
    return np.repeat((np.clip(x, 0, 1) * 255).astype(np.uint8)[..., None], 3, axis=-1)


def centre_crop2d(x: np.ndarray, size: int) -> np.ndarray:
    """N21."""
    a, b = (x.shape[-2] - size) // 2, (x.shape[-1] - size) // 2
    return x[..., a : a + size, b : b + size]


def mosaic(x: np.ndarray, columns: int) -> np.ndarray:
    """Slices side by side, row after row; places left over are zero."""
    rows = -(-len(x) // columns)
    full = end_fit(x, (rows * columns, *x.shape[1:]))
    return full.reshape(rows, columns, *x.shape[1:]).swapaxes(1, 2).reshape(rows * x.shape[1], columns * x.shape[2])


def blurred(x: np.ndarray, sigma: float = 1.5, width: int = 11) -> np.ndarray:
    """Each slice under a Gaussian window, edges mirrored as far as the slice goes."""
    at = np.arange(width) - width // 2
    kernel = np.exp(-(at**2) / (2 * sigma**2))
    kernel /= kernel.sum()
    for axis in (1, 2):
        pads = [(width // 2,) * 2 if i == axis else (0, 0) for i in range(3)]
        mode = "reflect" if x.shape[axis] > 1 else "edge"
        x = np.lib.stride_tricks.sliding_window_view(np.pad(x, pads, mode=mode), width, axis) @ kernel
    return x


def structural_similarity(a: np.ndarray, b: np.ndarray, width: int = 11) -> float:
    """Mean of the slices' similarity maps, without the edge of half a window where a slice is larger than a window; 1 for
    two volumes of one value each that are equal."""
    a, b = a.astype(float), b.astype(float)
    span = max(np.ptp(a), np.ptp(b)) or 1.0
    c1, c2 = (0.01 * span) ** 2, (0.03 * span) ** 2
    ma, mb = blurred(a), blurred(b)
    va, vb, cov = blurred(a * a) - ma * ma, blurred(b * b) - mb * mb, blurred(a * b) - ma * mb
    whole = (2 * ma * mb + c1) * (2 * cov + c2) / ((ma * ma + mb * mb + c1) * (va + vb + c2))
    edge = width // 2
    inner = whole[:, edge:-edge, edge:-edge] if min(a.shape[1:]) >= width else whole
    return float(inner.reshape(len(a), -1).mean(axis=1).mean())


def image_errors(made: np.ndarray, true: np.ndarray, peak: float | None = None) -> tuple[float, float | None, float]:
    """Mse, psnr (null where equal) and ssim by slices of a pair. The peak is the true volume's range, 0 included."""
    made, true = made.astype(float), true.astype(float)
    mse = float(((made - true) ** 2).mean())
    peak = max(true.max(), 0) - min(true.min(), 0) if peak is None else peak
    psnr = None if mse == 0 else float(10 * np.log10(peak**2 / mse)) if peak else -float("inf")
    return mse, psnr, structural_similarity(made, true)


def plane_slices(df: DataFrame, feature: Callable[[np.ndarray], list[float]], ratio: float = 1.0, step: int = 1) -> DataFrame:
    """(path, plane, index, feature): every plane slice of each volume through a feature hook, slice by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, shape, voxels in zip(*(batch.column(i) for i in range(3)), strict=True):
                x = np.frombuffer(voxels.as_py(), "<f4").reshape(shape.as_py())
                rows = [(name, i, feature(y)) for name, i, y in planes(x, ratio, step)]
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.float64()))], ["path", "plane", "index", "feature"])

    return df.select("path", "shape", "voxels").mapInArrow(run, "path string, plane string, index int, feature array<double>")


def map_volumes(df: DataFrame, step: Callable[[np.ndarray, tuple[float, ...]], np.ndarray]) -> DataFrame:
    """Apply ``step(array, spacing)`` to each volume of (path, shape, spacing, voxels)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, shape, spacing, voxels in zip(*(batch.column(i) for i in range(4)), strict=True):
                y = step(np.frombuffer(voxels.as_py(), "<f4").reshape(shape.as_py()), tuple(spacing.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([list(y.shape)], pa.list_(pa.int32())), pa.array([spacing.as_py()], pa.list_(pa.float64())), pa.array([np.ascontiguousarray(y, "<f4").tobytes()], pa.binary())], ["path", "shape", "spacing", "voxels"])

    return df.select("path", "shape", "spacing", "voxels").mapInArrow(run, "path string, shape array<int>, spacing array<double>, voxels binary")
