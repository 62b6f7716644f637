"""Thumbnails of decoded images."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text

BOX = 50
COLUMNS = ["origin", "height", "width", "nChannels", "mode", "data"]
SCHEMA = (
    "origin string, status string, error string, height int, width int, nChannels int, "
    "mode int, data binary"
)


ROWS_PER_BATCH = 64


def image_session(spark: SparkSession, rows_per_batch: int = ROWS_PER_BATCH) -> SparkSession:
    """A session of the same application in which Arrow batches hold few rows.

    Every row is a whole image, so the usual 10,000 of them would not fit in a task. Read
    the images with this session; the settings of the given one stay as they are.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_per_batch))
    return session


def thumbnail_size(height: int, width: int, box: int) -> tuple[int, int]:
    """The long edge becomes ``box``, the other keeps the ratio and is at least 1."""
    long = max(height, width)
    return (
        max(1, int(height * box / long + 0.5)),
        max(1, int(width * box / long + 0.5)),
    )


def area_weights(size: int, target: int) -> np.ndarray:
    """(target, size) matrix: share of each source cell in each target cell."""
    edges = np.arange(target + 1) * (size / target)
    cells = np.arange(size)
    low = np.maximum(edges[:-1, None], cells[None, :])
    high = np.minimum(edges[1:, None], cells[None, :] + 1)
    return np.clip(high - low, 0, None) * (target / size)


def overlaps(size: int, target: int) -> np.ndarray:
    """``area_weights`` as whole numbers: overlaps on a grid of size * target."""
    cells, wide = np.arange(size, dtype=np.int64) * target, np.arange(target, dtype=np.int64) * size
    low = np.maximum(wide[:, None], cells[None, :])
    high = np.minimum(wide[:, None] + size, cells[None, :] + target)
    return np.clip(high - low, 0, None)


def resample(pixels: np.ndarray, box: int) -> np.ndarray:
    """Area average of a (height, width, channels) byte image, in whole numbers; halves go to the
    even neighbour."""
    h, w, _ = pixels.shape
    th, tw = thumbnail_size(h, w, box)
    rows = np.tensordot(overlaps(h, th), pixels.astype(np.int64), axes=(1, 0))
    total = np.einsum("xw,hwc->hxc", overlaps(w, tw), rows)
    whole, rest = np.divmod(total, h * w)
    up = (2 * rest > h * w) | ((2 * rest == h * w) & (whole % 2 == 1))
    return (whole + up).astype(np.uint8)


def _thumbnail(row, box: int) -> tuple:
    if pd.isna(row.height) or row.height <= 0 or row.width <= 0 or row.data is None:
        return (row.origin, "error", "not an image", None, None, None, None, None)
    try:
        pixels = np.frombuffer(row.data, dtype=np.uint8).reshape(row.height, row.width, row.nChannels)
        small = resample(pixels, box)
    except ValueError as e:
        return (row.origin, "error", str(e), None, None, None, None, None)
    return (
        row.origin, "ok", None, small.shape[0], small.shape[1], row.nChannels, row.mode,
        small.tobytes(),
    )


def thumbnails(images: DataFrame, box: int = BOX, keep: list[str] | None = None) -> DataFrame:
    """Thumbnails in the image schema, with ``status``; undecodable images are error rows.

    ``keep`` names columns that are passed on as they are.
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    keep = keep or []

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [_thumbnail(r, box) for r in frame.itertuples(index=False)]
            out = pd.DataFrame(rows, columns=names)
            for c in ("height", "width", "nChannels", "mode"):
                out[c] = out[c].astype("Int32")
            for c in keep:
                out[c] = frame[c].to_numpy()
            yield out

    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in images.select(*keep).schema.fields)
    return images.select(*COLUMNS, *keep).mapInPandas(batches, SCHEMA + kept).withColumn(
        "format", text.image_format(F.col("origin"))
    )
