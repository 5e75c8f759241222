"""Sizes, token counts and frame choices of images and videos (geometry only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def smart_resize(height: Column | str, width: Column | str, factor: int = 28, min_pixels: int = 56 * 56, max_pixels: int = 28 * 28 * 1280) -> tuple[Column, Column]:
    """Both sides as multiples of factor (half to even), the area inside the bounds."""
    h, w = _col(height).cast("double"), _col(width).cast("double")
    rh, rw = (F.greatest(F.lit(factor), F.rint(x / factor) * factor) for x in (h, w))
    down, up = F.sqrt(h * w / max_pixels), F.sqrt(min_pixels / (h * w))
    small = lambda x: F.greatest(F.lit(factor), F.floor(x / down / factor) * factor)
    large = lambda x: F.ceil(x * up / factor) * factor
    pick = lambda x, r: F.when(rh * rw > max_pixels, small(x)).when(rh * rw < min_pixels, large(x)).otherwise(r).cast("long")
    return pick(h, rh), pick(w, rw)


def image_tokens(height: Column | str, width: Column | str, patch: int = 14, merge: int = 2) -> Column:
    return F.floor((_col(height) / patch).cast("long") * (_col(width) / patch).cast("long") / (merge * merge)).cast("long")


def aspect_name(height: Column | str, width: Column | str) -> Column:
    ratio = _col(width) / _col(height)
    return F.when(ratio < 0.85, "tall").when(ratio > 1.18, "wide").otherwise("square")


#: The standard aspect ratios (width, height).
ASPECTS = ((1, 2), (9, 16), (2, 3), (3, 4), (4, 5), (1, 1), (5, 4), (4, 3), (3, 2), (16, 10), (5, 3), (16, 9), (2, 1), (21, 9))


def bucket_table(pixels: int, quantum: int = 64, aspects: Sequence[tuple[int, int]] = ASPECTS) -> list[tuple[int, int, int]]:
    """(id, width, height): distinct resolutions in multiples of the quantum (half to even) under a pixel budget, by aspect ratio."""
    found = set()
    for a, b in aspects:
        near = lambda n: round(int(n) / quantum) * quantum
        h = near((pixels * b / a) ** 0.5)
        w = near(h * a / b)
        while w * h > pixels:
            w, h = (w - quantum, h) if w >= h else (w, h - quantum)
        if min(w, h) >= quantum:
            found.add((w, h))
    return [(i, w, h) for i, (w, h) in enumerate(sorted(found, key=lambda r: r[0] / r[1]))]


def nearest_bucket(height: Column | str, width: Column | str, buckets: Sequence[tuple[int, int, int]]) -> Column:
    """Id of the bucket with the nearest aspect ratio; the first of equals."""
    ratio = _col(width).cast("double") / _col(height)
    gaps = F.array(*[F.struct(F.round(F.abs(ratio - w / h), 9).alias("gap"), F.lit(i).alias("id")) for i, w, h in buckets])
    return F.array_min(gaps)["id"]


def batch_size(base: int, ratio: Column | str) -> Column:
    return F.greatest(F.lit(1), F.floor(base / _col(ratio))).cast("long")


def even_frames(n_frames: Column | str, wanted: int) -> Column:
    """Indices evenly spaced from the first to the last frame."""
    n = _col(n_frames)
    if wanted == 1:
        return F.array(F.lit(0).cast("long"))
    return F.transform(F.sequence(F.lit(0), F.lit(wanted - 1)), lambda i: F.floor(i * (n - 1) / (wanted - 1)).cast("long"))


def middle_frames(n_frames: Column | str, wanted: int) -> Column:
    """The middle frame of each of ``wanted`` equal intervals; short videos repeat the last frame."""
    n = _col(n_frames)
    return F.transform(F.sequence(F.lit(0), F.lit(wanted - 1)), lambda i: F.least(F.when(n <= wanted, i).otherwise(F.floor((2 * i + 1) * n / (2 * wanted))), n - 1).cast("long"))


def frames_4n1(n_frames: Column | str) -> Column:
    """The greatest number 4n + 1 that is not above the number of frames."""
    return (4 * F.floor((_col(n_frames) - 1) / 4) + 1).cast("long")


def sample_tokens(n_chars: Column | str, media_tokens: Column | str | None, n_media: Column | str) -> Column:
    """Estimated length: characters // 3 and, unless known, 500 tokens a medium."""
    known = F.lit(None).cast("long") if media_tokens is None else _col(media_tokens)
    return (F.floor(_col(n_chars) / 3) + F.coalesce(known, 500 * _col(n_media))).cast("long")


def grid_tokens(grids: Column | str, merge: int = 2) -> Column:
    """Sum over rows of the product of a grid, each floored by merge squared; null counts 0."""
    product = lambda g: F.aggregate(g, F.lit(1).cast("long"), lambda acc, x: acc * x)
    total = F.aggregate(_col(grids), F.lit(0).cast("long"), lambda acc, g: acc + F.floor(product(g) / (merge * merge)))
    return F.coalesce(total, F.lit(0))


def cover_crop(height: Column | str, width: Column | str, to_h: Column | str, to_w: Column | str) -> dict[str, Column]:
    """Scale that covers the target and the centre crop's offsets."""
    h, w, th, tw = (_col(x).cast("double") for x in (height, width, to_h, to_w))
    scale = F.greatest(th / h, tw / w)
    rh, rw = F.greatest(F.rint(h * scale), th), F.greatest(F.rint(w * scale), tw)
    return {"resized_height": rh.cast("long"), "resized_width": rw.cast("long"), "top": F.floor((rh - th) / 2).cast("long"), "left": F.floor((rw - tw) / 2).cast("long")}
