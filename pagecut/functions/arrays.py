"""Array functions for images stored as flat or nested float arrays.

All are higher-order Spark SQL expressions (JVM, inside whole-stage codegen);
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise(a: Column, scale: float = 255.0) -> Column:
    """``x / 255`` as float, element-wise."""
    return F.transform(a, lambda x: (x.cast("double") / F.lit(scale)).cast("float"))


def rescale_pm1(a: Column) -> Column:
    """Pixel 0..255 -> [-1, 1]: ``x / 127.5 - 1``."""
    return F.transform(a, lambda x: (x.cast("double") / F.lit(127.5) - F.lit(1.0)).cast("float"))


def flatten2d(a: Column) -> Column:
    """Row-major flatten of ``array<array<T>>``."""
    return F.flatten(a)


def reshape(a: Column, h: int, w: int) -> Column:
    """Flat array of ``h*w`` values -> ``h`` rows of ``w``."""
    return F.transform(F.sequence(F.lit(0), F.lit(h - 1)),
                       lambda i: F.slice(a, i * F.lit(w) + F.lit(1), F.lit(w)))


def add_channel(a: Column) -> Column:
    """``[..., newaxis]`` on a flat array: each value becomes a 1-element array."""
    return F.transform(a, lambda x: F.array(x))


def repeat_channels(a: Column, n: int = 3) -> Column:
    """Gray -> ``n`` identical channels, per pixel."""
    return F.transform(a, lambda x: F.array_repeat(x, n))


def quantise(a: Column, offset: float = 0.6, scale: float = 200.0) -> Column:
    """Floats -> 8-bit pixels ``clamp(floor((x + offset) * scale), 0, 255)``."""
    return F.transform(a, lambda x: F.least(F.lit(255), F.greatest(
        F.lit(0), F.floor((x.cast("double") + F.lit(offset)) * F.lit(scale)).cast("int"))))


def rgb_to_gray(r: Column, g: Column, b: Column) -> Column:
    """Luma 0.299 R + 0.587 G + 0.114 B per pixel (double)."""
    return F.zip_with(F.zip_with(r, g, lambda x, y: F.lit(0.299) * x + F.lit(0.587) * y),
                      b, lambda s, z: s + F.lit(0.114) * z)


def rotate(a: Column, k: int) -> Column:
    """Cyclic left rotation by ``k`` positions."""
    return F.concat(F.slice(a, k + 1, F.size(a) - k), F.slice(a, 1, k))


def shrink2x(a: Column, h: int, w: int) -> Column:
    """Exact 2x down-scale = mean of each 2x2 block (bilinear, half-pixel centres)."""
    oh, ow = h // 2, w // 2

    def at(r, c):
        return F.element_at(a, r * F.lit(w) + c + F.lit(1)).cast("double")

    return F.transform(F.sequence(F.lit(0), F.lit(oh * ow - 1)), lambda i: (
        at(F.floor(i / ow) * 2, (i % ow) * 2) + at(F.floor(i / ow) * 2, (i % ow) * 2 + 1)
        + at(F.floor(i / ow) * 2 + 1, (i % ow) * 2) + at(F.floor(i / ow) * 2 + 1, (i % ow) * 2 + 1)
    ) / F.lit(4.0))


def shift_nearest(a: Column, h: int, w: int, dx: Column, dy: Column) -> Column:
    """Translate an ``h x w`` image by ``(dx, dy)`` pixels, nearest-edge fill."""
    def clamp(v, hi):
        return F.least(F.lit(hi), F.greatest(F.lit(0), v))

    return F.transform(F.sequence(F.lit(0), F.lit(h * w - 1)), lambda i: F.element_at(
        a, (clamp(F.floor(i / w) - dy, h - 1) * F.lit(w) + clamp(i % w - dx, w - 1) + F.lit(1)).cast("int")))


def dot(a: Column, weights: list[float]) -> Column:
    """Dot product of a float array with fixed weights (double accumulation)."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    return F.aggregate(F.zip_with(a, w, lambda x, y: x.cast("double") * y), F.lit(0.0),
                       lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def prefix_sum(a: Column, n: int) -> Column:
    """Sum of the first ``n`` elements, as double."""
    return array_sum(F.slice(a, 1, n))
