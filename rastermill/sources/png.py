"""Report pictures: band stretch and a PNG encoder."""

from __future__ import annotations

import struct
import zlib

import numpy as np


def displayed(image: np.ndarray) -> np.ndarray:
    """(bands, h, w) as (h, w, 1 or 3) bytes: the first three bands by their type's largest value."""
    x = image[: 3 if len(image) >= 3 else 1].transpose(1, 2, 0).astype(np.float64)
    top = np.iinfo(image.dtype).max if image.dtype.kind in "iu" else max(float(x.max(initial=0)), 1.0)
    return np.clip(x / top * 255, 0, 255).astype(np.uint8)


def stretched(image: np.ndarray) -> np.ndarray:
    """Like displayed, but from the patch's least to its largest value."""
    x = image[: 3 if len(image) >= 3 else 1].transpose(1, 2, 0).astype(np.float64)
    return np.clip((x - x.min()) / (x.max() - x.min() + 1e-6) * 255, 0, 255).astype(np.uint8)


def png(pixels: np.ndarray) -> bytes:
    """(h, w, 1 or 3) bytes as a PNG file."""
    h, w, channels = pixels.shape
    rows = np.concatenate([np.zeros((h, 1), np.uint8), pixels.reshape(h, -1)], axis=1).tobytes()
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2}[channels], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def gallery(images: list[np.ndarray], columns: int = 4, gap: int = 2) -> np.ndarray:
    """Equal (h, w, c) pictures side by side."""
    if not images:
        return np.zeros((1, 1, 1), np.uint8)
    h, w, c = images[0].shape
    rows = -(-len(images) // columns)
    out = np.full((rows * (h + gap) - gap, min(columns, len(images)) * (w + gap) - gap, c), 255, np.uint8)
    for k, image in enumerate(images):
        y, x = divmod(k, columns)
        out[y * (h + gap) : y * (h + gap) + h, x * (w + gap) : x * (w + gap) + w] = image
    return out
