import struct
import zlib

import numpy as np
import pytest

from lexigraph.operators import imaging
from lexigraph.sinks import writers
from lexigraph.sources import readers


def png(path, height, width, rgb):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    raw = (b"\0" + bytes(rgb) * width) * height
    path.write_bytes(
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
        + chunk(b"IDAT", zlib.compress(raw))
        + chunk(b"IEND", b"")
    )


def test_thumbnails_of_files(spark, tmp_path):
    sizes = {"a.png": (60, 100), "b.JPE": (100, 60), "c.png": (10, 10), "d.png": (1, 500)}
    folder = tmp_path / "images"
    folder.mkdir()
    for name, (h, w) in sizes.items():
        png(folder / name, h, w, (10, 20, 30))
    (folder / "junk.png").write_bytes(b"no image")
    thumbs = imaging.thumbnails(readers.read_images(imaging.image_session(spark, 2), str(folder)))
    got = {r.origin.rsplit("/", 1)[-1]: r for r in thumbs.collect()}
    assert {k: (r.height, r.width) for k, r in got.items() if r.status == "ok"} == {
        "a.png": (30, 50), "b.JPE": (50, 30), "c.png": (50, 50), "d.png": (1, 50)
    }
    assert got["junk.png"].status == "error" and got["junk.png"].data is None
    assert got["b.JPE"].format == "jpg"
    for r in got.values():
        if r.status == "ok":
            assert bytes(r.data) == bytes((30, 20, 10)) * (r.height * r.width)
    writers.write_thumbnails(thumbs, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


@pytest.mark.parametrize("h, w", [(100, 60), (64, 131), (7, 3), (50, 50), (1, 9), (203, 51)])
def test_pixels_against_brute_force(h, w):
    pixels = np.random.default_rng(h * w).integers(0, 256, (h, w, 3), dtype=np.uint8)
    small = imaging.resample(pixels, 50)
    th, tw = small.shape[:2]
    assert (th, tw) == imaging.thumbnail_size(h, w, 50) and max(th, tw) == 50

    def share(cell, size, target, k):
        low, high = cell * size / target, (cell + 1) * size / target
        return max(0.0, min(high, k + 1) - max(low, k)) * target / size

    rng = np.random.default_rng(1)
    for _ in range(40):
        y, x = rng.integers(0, th), rng.integers(0, tw)
        mean = sum(
            share(y, h, th, a) * share(x, w, tw, b) * pixels[a, b].astype(float)
            for a in range(h) if share(y, h, th, a) > 0
            for b in range(w) if share(x, w, tw, b) > 0
        )
        assert np.abs(small[y, x].astype(float) - mean).max() <= 0.5 + 1e-6


def test_ratios_that_are_not_whole_round_exactly():
    """Weights as fractions: every pixel is the exact mean, halves go to the even neighbour."""
    from fractions import Fraction

    rng = np.random.default_rng(2)
    for h, w, box in ((34, 30, 16), (7, 5, 3), (5, 9, 4), (2, 3, 5)):
        image = rng.integers(0, 256, (h, w, 2)).astype(np.uint8)
        small = imaging.resample(image, box)
        th, tw, _ = small.shape
        for ty in range(th):
            for tx in range(tw):
                for c in range(2):
                    total = Fraction(0)
                    for y in range(h):
                        oy = min(Fraction(y + 1), Fraction((ty + 1) * h, th)) - max(Fraction(y), Fraction(ty * h, th))
                        for x in range(w):
                            ox = min(Fraction(x + 1), Fraction((tx + 1) * w, tw)) - max(Fraction(x), Fraction(tx * w, tw))
                            if oy > 0 and ox > 0:
                                total += oy * ox * int(image[y, x, c])
                    assert small[ty, tx, c] == round(total * Fraction(th * tw, h * w))


def test_overlaps_are_the_area_weights():
    for size, target in ((7, 3), (3, 7), (16, 4), (5, 5)):
        assert np.allclose(imaging.overlaps(size, target) / size, imaging.area_weights(size, target))
