"""A 64-bit perceptual hash of images: grey, 32 by 32, discrete cosine transform, low frequencies above their median.

The reductions are by area, so values differ in a few bits from libraries that resample otherwise; distances behave alike."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _dct(n: int) -> np.ndarray:
    k = np.arange(n)
    return np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n))


def _areas(size: int, n: int) -> np.ndarray:
    """Weights by which ``n`` equal stretches average ``size`` pixels."""
    edges = np.linspace(0, size, n + 1)
    return np.clip(np.minimum(edges[1:, None], np.arange(1, size + 1)) - np.maximum(edges[:-1, None], np.arange(size)), 0, None) / np.diff(edges)[:, None]


def _lines(size: int, n: int) -> np.ndarray:
    """Weights by which ``n`` points are interpolated between the middles of ``size`` pixels."""
    at = np.clip((np.arange(n) + 0.5) * size / n - 0.5, 0, size - 1)
    low = np.minimum(at.astype(int), max(0, size - 2))
    out = np.zeros((n, size))
    out[np.arange(n), low] = 1 - (at - low)
    if size > 1:
        out[np.arange(n), low + 1] = at - low
    return out


def resized(pixels: np.ndarray, to: int) -> np.ndarray:
    """A square of ``to`` pixels a side: by area where both sides shrink, else by interpolation; 0 leaves the image as it is."""
    if not to:
        return pixels
    weights = _areas if pixels.shape[0] >= to and pixels.shape[1] >= to else _lines
    rows, cols = weights(pixels.shape[0], to), weights(pixels.shape[1], to)
    grey = pixels.astype(np.float64)
    return np.einsum("ar,rc...,bc->ab...", rows, grey, cols)


def grey_of(pixels: np.ndarray) -> np.ndarray:
    """Brightness of an array of blue, green and red, or of grey alone."""
    grey = pixels.astype(np.float64)
    if grey.ndim == 3:
        grey = grey[..., :3] @ np.array([0.114, 0.587, 0.299]) if grey.shape[2] > 2 else grey[..., 0]
    return grey


def hash_words(pixels: np.ndarray, size: int = 8, scale: int = 4) -> list[int]:
    """Hash of ``size`` times ``size`` bits of a grey or colour array of rows by columns, as signed words of 64 bits; the last word is
    filled with zeros."""
    grey, n = grey_of(pixels), size * scale
    small = _areas(grey.shape[0], n) @ grey @ _areas(grey.shape[1], n).T
    low = (_dct(n) @ small @ _dct(n).T)[:size, :size]
    bits = (low > np.median(low)).ravel()
    packed = np.packbits(np.pad(bits, (0, -len(bits) % 64)))
    return packed.view(">i8").astype(np.int64).tolist()


def hash_pixels(pixels: np.ndarray) -> int:
    """Signed 64-bit hash of an array."""
    return hash_words(pixels)[0]


#: The hash of a black image, which can stand for one that can't be read.
BLACK = hash_pixels(np.zeros((8, 8)))


def png(pixels: np.ndarray) -> bytes:
    """A PNG file of an array of blue, green and red, or of grey."""
    pixels = np.asarray(pixels, dtype=np.uint8)
    colour = pixels.ndim == 3 and pixels.shape[2] > 2
    body = pixels[..., 2::-1] if colour else pixels.reshape(*pixels.shape[:2], -1)[..., :1]
    high, wide = pixels.shape[:2]
    raw = b"".join(b"\0" + row.tobytes() for row in np.ascontiguousarray(body))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", wide, high, 8, 2 if colour else 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def _pixels(height: int, width: int, channels: int, data: bytes | None) -> np.ndarray | None:
    fine = data is not None and height and width and height > 0 and width > 0 and len(data) == height * width * channels
    return np.frombuffer(data, np.uint8).reshape(int(height), int(width), int(channels)) if fine else None


def perceptual_hash(image: Column, resize: int = 0, size: int = 8) -> Column:
    """Of a struct that Spark's image source makes, reduced to ``resize`` pixels a side first if that isn't 0; null where it
    can't be read.  A number for ``size`` 8, else an array of words."""

    @F.pandas_udf("array<long>")
    def of(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
        read = (_pixels(*x) for x in zip(height, width, channels, data))
        return pd.Series([None if p is None else hash_words(resized(p, resize), size) for p in read], dtype=object)

    words = of(image["height"], image["width"], image["nChannels"], image["data"])
    return F.get(words, 0) if size == 8 else words


def montage(cells: list[tuple[int, int, np.ndarray | None]], wide: int, high: int, cell: int, ground: int = 20) -> np.ndarray:
    """A page of pictures, each fitted into the square at its place (x, y) and centred; one that can't be read leaves a frame."""
    page = np.full((high, wide, 3), ground, dtype=np.uint8)
    for x, y, pixels in cells:
        if pixels is None:
            page[y : y + cell, x : x + cell] = np.where(np.pad(np.zeros((cell - 2, cell - 2, 1)), ((1, 1), (1, 1), (0, 0)), constant_values=1) > 0, [0, 0, 120], ground)
            continue
        h, w = pixels.shape[:2]
        scale = min(1.0, cell / max(h, w))
        rows, cols = max(1, int(h * scale)), max(1, int(w * scale))
        small = np.einsum("ar,rcd,bc->abd", _areas(h, rows), pixels.astype(float), _areas(w, cols)) if scale < 1 else pixels
        top, left = y + (cell - rows) // 2, x + (cell - cols) // 2
        page[top : top + rows, left : left + cols] = np.broadcast_to(small[..., :3], (rows, cols, 3)) if small.shape[2] != 2 else small[..., :1]
    return page
