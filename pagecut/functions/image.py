"""Image work: the one place where Python runs per value.

Pixels are decoded by Spark's ``image`` source in the JVM (BGR byte order);
the NumPy work below runs on Arrow batches, a slice of images at a
time.  Every UDF is pure: an image that cannot be processed gives null, never
a failed task.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 8-bit RGB -> gray luma weights in 14-bit fixed point
# (0.299, 0.587, 0.114 scaled by 2**14 = 4899, 9617, 1868), rounding 8192.
GRAY_WEIGHTS_FIXED = (4899, 9617, 1868)
GRAY_SHIFT = 14
#: Bytes of features that a task hands on at once.
SLICE_BYTES = 8 << 20


def gray_u8(rgb: np.ndarray) -> np.ndarray:
    """``(h, w, 3)`` uint8 RGB -> ``(h, w)`` uint8 gray, fixed-point rounding."""
    r, g, b = (rgb[..., i].astype(np.int64) for i in range(3))
    wr, wg, wb = GRAY_WEIGHTS_FIXED
    return ((r * wr + g * wg + b * wb + (1 << (GRAY_SHIFT - 1))) >> GRAY_SHIFT).astype(np.uint8)


def _axis(n_in: int, n_out: int):
    # half-pixel centres: src = (dst + 0.5) * n_in / n_out - 0.5, clamped at 0
    src = (np.arange(n_out) + 0.5) * (n_in / n_out) - 0.5
    src = np.maximum(src, 0.0)
    i0 = np.minimum(np.floor(src).astype(np.int64), n_in - 1)
    i1 = np.minimum(i0 + 1, n_in - 1)
    frac = src - i0
    return i0, i1, frac


def resize_bilinear(img: np.ndarray, out_h: int, out_w: int) -> np.ndarray:
    """Bilinear resize of ``(..., h, w)`` arrays with half-pixel centres."""
    h, w = img.shape[-2], img.shape[-1]
    y0, y1, fy = _axis(h, out_h)
    x0, x1, fx = _axis(w, out_w)
    a = img.astype(np.float64)
    top = a[..., y0, :][..., x0] * (1 - fx) + a[..., y0, :][..., x1] * fx
    bot = a[..., y1, :][..., x0] * (1 - fx) + a[..., y1, :][..., x1] * fx
    return top * (1 - fy)[:, None] + bot * fy[:, None]


def _stack(series: pd.Series, h: int, w: int):
    """Stack a batch of flat arrays into ``(n, h, w)``; bad rows are masked."""
    ok = series.map(lambda v: v is not None and len(v) == h * w).to_numpy(dtype=bool)
    out = np.zeros((len(series), h, w), dtype=np.float64)
    if ok.any():
        out[ok] = np.stack([np.asarray(v, dtype=np.float64) for v in series[ok]]).reshape(-1, h, w)
    return out, ok


def resize_udf(h: int, w: int, out_h: int, out_w: int):
    """Pandas UDF: flat ``h*w`` array -> flat ``out_h*out_w`` resized doubles."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def resize(col: pd.Series) -> pd.Series:
        imgs, ok = _stack(col, h, w)
        res = resize_bilinear(imgs, out_h, out_w).reshape(len(col), -1)
        return pd.Series([list(r) if k else None for r, k in zip(res, ok)])
    return resize


def pixel_features_udf(h: int, w: int, out_h: int, out_w: int):
    """Pandas UDF: 8-bit gray pixels (flat) -> resized, rounded, /255, flat floats.

    The 8-bit path: resize in floating point, round half to even back to
    0..255, then scale to [0, 1].  Wrong-sized or null input gives null.
    """
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def features(col: pd.Series) -> pd.Series:
        imgs, ok = _stack(col, h, w)
        res = np.clip(np.rint(resize_bilinear(imgs, out_h, out_w)), 0, 255) / 255.0
        res = res.astype(np.float32).reshape(len(col), -1)
        return pd.Series([list(r) if k else None for r, k in zip(res, ok)])
    return features


def _gray(h: int | None, w: int | None, c: int | None, data: pa.Scalar) -> np.ndarray | None:
    """Parts of a Spark image -> ``(h, w)`` uint8 gray, or None when undecodable."""
    if not h or not w or not c or min(h, w, c) <= 0 or not data.is_valid or data.as_buffer().size != h * w * c:
        return None
    px = np.frombuffer(data.as_buffer(), dtype=np.uint8).reshape(h, w, c)
    if c == 1:
        return px[..., 0]
    # Spark stores BGR(A); luma wants RGB
    return gray_u8(px[..., 2::-1][..., :3] if c >= 3 else px)


def plain_png(data: bytes) -> np.ndarray | None:
    """``(h, w)`` gray or ``(h, w, 3)`` RGB samples of a plain PNG: 8 bits a sample, not interlaced, nothing but
    header, data and end, rows stored as they are or as differences to the left or the row above.  None for any other file."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    at, chunks = 8, []
    while at + 12 <= len(data):
        end = at + 12 + int.from_bytes(data[at:at + 4], "big")
        if end > len(data) or zlib.crc32(data[at + 4:end - 4]) != int.from_bytes(data[end - 4:end], "big"):
            return None
        chunks.append((data[at + 4:at + 8], data[at + 8:end - 4]))
        at = end
    names = [name for name, _ in chunks]
    if at != len(data) or len(names) < 3 or names != [b"IHDR", *[b"IDAT"] * (len(names) - 2), b"IEND"] or len(chunks[0][1]) != 13:
        return None
    head = chunks[0][1]
    w, h = int.from_bytes(head[:4], "big"), int.from_bytes(head[4:8], "big")
    c = {b"\x08\x00\x00\x00\x00": 1, b"\x08\x02\x00\x00\x00": 3}.get(head[8:])
    if not c or not w or not h:
        return None
    size = h * (w * c + 1)
    try:
        inflate = zlib.decompressobj()
        raw = inflate.decompress(b"".join(body for _, body in chunks[1:-1]), size + 1)
    except zlib.error:
        return None
    if len(raw) != size or not inflate.eof or inflate.unused_data:
        return None
    lines = np.frombuffer(raw, np.uint8).reshape(h, w * c + 1)
    kinds, px = lines[:, 0], lines[:, 1:].reshape(h, w, c)
    if (kinds > 2).any():
        return None
    if kinds.any():
        px = px.copy()
        px[kinds == 1] = np.cumsum(px[kinds == 1], axis=1, dtype=np.uint8)
        for y in np.flatnonzero(kinds == 2):
            if y:
                px[y] += px[y - 1]
    return px[..., 0] if c == 1 else px


def _scaled(grays: list[np.ndarray], out_h: int, out_w: int) -> list[np.ndarray]:
    """Each gray image resized, scaled and flat; images of one size are worked off together, ``SLICE_BYTES`` at a time."""
    out, by_size = [None] * len(grays), {}
    for i, gray in enumerate(grays):
        by_size.setdefault(gray.shape, []).append(i)
    for (h, w), at in by_size.items():
        step = max(1, SLICE_BYTES // (8 * max(h * w, out_h * out_w)))
        for lo in range(0, len(at), step):
            some = at[lo:lo + step]
            resized = resize_bilinear(np.stack([grays[i] for i in some]), out_h, out_w)
            flat = (np.clip(np.rint(resized), 0, 255) / 255.0).astype(np.float32).reshape(len(some), -1)
            for i, row in zip(some, flat):
                out[i] = row
    return out


def _lists(grays: list[np.ndarray | None], out_h: int, out_w: int, as_rows: bool = False) -> pa.Array:
    """Resized, scaled images as one Arrow list array over a flat buffer; null for None."""
    known = np.array([g is not None for g in grays], bool)
    flat = _scaled([g for g in grays if g is not None], out_h, out_w)
    values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.float32))
    width = out_h * out_w
    if as_rows:
        values = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, out_w), pa.int32()), values)
        width = out_h
    ends = np.concatenate([[0], np.cumsum(known) * width])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array(~known))


def _features(images: pa.StructArray, out_h: int, out_w: int, as_rows: bool) -> pa.Array:
    """Gray, resized, scaled images as one Arrow list array; null where undecodable."""
    names = [f.name for f in images.type]
    parts = dict(zip(names, images.flatten()))
    size = [parts[c].to_pylist() for c in ("height", "width", "nChannels")]
    return _lists([_gray(h, w, c, parts["data"][i]) for i, (h, w, c) in enumerate(zip(*size))], out_h, out_w, as_rows)


def plain_png_features_udf(out_h: int = 224, out_w: int = 224):
    """Arrow UDF over the content of files: the features of ``image_features_udf`` for a plain PNG, null for any other file.

    Spark's ``image`` source spends milliseconds on each file, however small; this leaves it the files that need it.
    """
    step = max(1, SLICE_BYTES // (4 * out_h * out_w))

    def gray(content: pa.Scalar) -> np.ndarray | None:
        px = plain_png(content.as_py()) if content.is_valid else None
        return px if px is None or px.ndim == 2 else gray_u8(px)

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for files in batches:
            for lo in range(0, len(files), step):
                yield _lists([gray(f) for f in files.slice(lo, step)], out_h, out_w)
    return features.asNondeterministic()


def image_features_udf(out_h: int = 224, out_w: int = 224, as_rows: bool = False):
    """Arrow UDF over an ``image`` struct: gray, resize, /255, flatten (or rows); null when undecodable.

    A batch is worked off in slices of ``SLICE_BYTES`` of features, so the memory of a task depends neither
    on the batch nor on the image size.  It is marked non-deterministic although it is not: so a
    filter on its result reads the column that was computed and doesn't decode every image again.
    """
    step = max(1, SLICE_BYTES // (4 * out_h * out_w))
    kind = T.ArrayType(T.FloatType())

    @F.arrow_udf(T.ArrayType(kind) if as_rows else kind)
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for images in batches:
            for lo in range(0, len(images), step):
                yield _features(images.slice(lo, step), out_h, out_w, as_rows)
    return features.asNondeterministic()


def image_2d_udf(out_h: int = 224, out_w: int = 224):
    """Like ``image_features_udf`` but returns rows: ``array<array<float>>``."""
    return image_features_udf(out_h, out_w, as_rows=True)


def image_features(img: Column, out_h: int = 224, out_w: int = 224) -> Column:
    """``preprocess_image``: image struct -> ``array<float>`` of ``out_h*out_w`` or null."""
    return image_features_udf(out_h, out_w)(img)


def hash_uniform(seed: int, rid: int, variant: int, k: int) -> float:
    """The ``k``-th number in [0, 1) of one variant: the first 32 bits of an MD5, so any engine draws the same."""
    return int(hashlib.md5(f"{seed}:{rid}:{variant}:{k}".encode()).hexdigest()[:8], 16) / 2 ** 32


def augment_udf(h: int, w: int, variants: int, rotation: float = 10.0, zoom: float = 0.1,
                shift: float = 0.1, seed: int = 42):
    """Batch function for ``mapInPandas``: ``variants`` augmented copies per image.

    Each copy gets a rotation (degrees), independent x/y zoom factors and
    x/y shifts (fractions of the size) by ``hash_uniform`` of ``(seed, id,
    variant)``, so a retried task yields the same rows.  Pixels
    are resampled bilinearly; outside points take the nearest edge pixel; no
    flips.  An image of another size, or without pixels, gives null pixels.
    """
    yy, xx = np.mgrid[0:h, 0:w].astype(np.float64)
    cy, cx = (h - 1) / 2.0, (w - 1) / 2.0

    def one(img: np.ndarray, rid: int, variant: int) -> np.ndarray:
        ang, zy, zx, ty, tx = (2 * hash_uniform(seed, rid, variant, k) - 1 for k in range(5))
        ang, zy, zx, ty, tx = np.deg2rad(ang * rotation), 1 + zy * zoom, 1 + zx * zoom, ty * shift * h, tx * shift * w
        cos, sin = np.cos(ang), np.sin(ang)
        # output pixel -> source coordinate (inverse of rotate, zoom, shift)
        dy, dx = yy - cy - ty, xx - cx - tx
        sy = np.clip((dy * cos - dx * sin) * zy + cy, 0, h - 1)
        sx = np.clip((dy * sin + dx * cos) * zx + cx, 0, w - 1)
        y0, x0 = np.floor(sy).astype(np.int64), np.floor(sx).astype(np.int64)
        y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
        fy, fx = sy - y0, sx - x0
        top = img[y0, x0] * (1 - fx) + img[y0, x1] * fx
        bot = img[y1, x0] * (1 - fx) + img[y1, x1] * fx
        return top * (1 - fy) + bot * fy

    def run(batches, id_col: str, pix_col: str):
        for pdf in batches:
            for rid, px in zip(pdf[id_col], pdf[pix_col]):  # one image's variants are held at a time
                fits = px is not None and len(px) == h * w
                img = np.asarray(px, dtype=np.float64).reshape(h, w) if fits else None
                rows = [(rid, v, one(img, int(rid), v).ravel().tolist() if fits else None)
                        for v in range(variants)]
                yield pd.DataFrame(rows, columns=[id_col, "variant", pix_col])
    return run


def encode_png_gray(pixels: np.ndarray) -> bytes:
    """Minimal 8-bit gray PNG encoder (zlib + struct), for fixtures and sinks."""
    import struct
    import zlib

    h, w = pixels.shape
    raw = b"".join(b"\x00" + bytes(pixels[r].astype(np.uint8)) for r in range(h))

    def chunk(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body) & 0xFFFFFFFF)

    ihdr = struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw))
            + chunk(b"IEND", b""))


def png_udf(h: int, w: int):
    """Pandas UDF: flat 8-bit pixel array -> PNG bytes."""
    @F.pandas_udf(T.BinaryType())
    def png(col: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else encode_png_gray(np.asarray(v).reshape(h, w)) for v in col])
    return png
