import numpy as np
import pytest

from vantagrid.functions import png, raster
from vantagrid.functions.raster import Box


def blank(h=64, w=64, c=3):
    return np.zeros((h, w, c), np.uint8)


def lit(*blocks, h=64, w=64):
    out = np.zeros((h, w), bool)
    for y0, y1, x0, x1 in blocks:
        out[y0:y1, x0:x1] = True
    return out


def by_flood(map_):
    """Components by flood fill, as (x, y, w, h, area) in any order."""
    left, out = set(zip(*np.nonzero(map_), strict=True)), []
    while left:
        todo, own = [left.pop()], []
        while todo:
            y, x = todo.pop()
            own.append((y, x))
            for n in [(y + dy, x + dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]:
                if n in left:
                    left.remove(n)
                    todo.append(n)
        ys, xs = [p[0] for p in own], [p[1] for p in own]
        out.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, len(own)))
    return sorted(out)


def test_nothing_lit():
    assert raster.components(raster.binarise(blank(), 12)) == []
    assert raster.instances(raster.binarise(blank(), 12), 0) == []


def test_threshold_is_strict():
    m = blank()
    m[5:15, 5:15] = 12
    assert not raster.binarise(m, 12).any()
    assert raster.binarise(m, 11).sum() == 100


def test_one_blob():
    (b,) = raster.components(lit((10, 30, 5, 15)))
    assert b == Box(5, 10, 10, 20, 200, 1) and b.fill_ratio == 1.0 and b.box_area == 200


def test_any_channel_counts_and_alpha_does_not():
    m = blank()
    m[3:8, 3:8, 2] = 200
    assert raster.components(raster.binarise(m, 12))[0].mask_area == 25
    m = np.full((32, 32, 4), 0, np.uint8)
    m[:, :, 3] = 255
    m[4:12, 4:12, :3] = 90
    (b,) = raster.components(raster.binarise(m, 12))
    assert b.mask_area == 64


def test_grey_mask():
    m = np.zeros((32, 32), np.uint8)
    m[2:10, 2:10] = 255
    assert len(raster.components(raster.binarise(m, 12))) == 1


def test_largest_first_and_stable():
    assert [b.mask_area for b in raster.components(lit((0, 5, 0, 5), (20, 40, 20, 40)))] == [400, 25]
    assert [b.x for b in raster.components(lit((0, 5, 30, 35), (10, 15, 0, 5)))] == [30, 0]


def test_corners_connect():
    m = lit((0, 2, 0, 2), (2, 4, 2, 4))
    assert len(raster.components(m)) == 1


@pytest.mark.parametrize("share", [0.1, 0.35, 0.6])
def test_components_against_flood_fill(share):
    draw = np.random.default_rng(7)
    for _ in range(20):
        m = draw.random((17, 23)) < share
        got = sorted((b.x, b.y, b.w, b.h, b.mask_area) for b in raster.components(m))
        assert got == by_flood(m)


def test_long_chain_of_runs():
    m = np.zeros((64, 64), bool)
    for y in range(0, 64, 2):
        m[y] = True
        m[y + 1, 0 if y % 4 else 63] = True
    assert len(raster.components(m)) == 1


def test_pieces_make_one_instance():
    (b,) = raster.instances(lit((20, 40, 20, 40), (20, 40, 46, 52)), 16)
    assert (b.x, b.w, b.components) == (20, 32, 2)
    (b,) = raster.instances(lit((10, 40, 10, 20), (10, 40, 30, 40)), 16)
    assert (b.y, b.h, b.mask_area, b.components) == (10, 30, 600, 2) and b.fill_ratio == 600 / 900
    (b,) = raster.instances(lit((0, 3, 0, 3), (30, 50, 30, 50)), 16)
    assert (b.components, b.mask_area) == (2, 409)


def test_small_instance_is_dropped_by_its_box():
    assert raster.instances(lit((0, 3, 0, 3)), 16) == []
    assert raster.instances(lit((0, 3, 0, 3)), 9) != []


def scene(object_grey, back, alpha=255, rim=None):
    normal, mask = np.full((96, 96, 3), back, np.uint8), blank(96, 96)
    mask[40:52, 40:52], normal[40:52, 40:52] = alpha, object_grey
    if rim:
        mask[39, 39:53], normal[39, 39:53] = rim
    m = raster.binarise(mask, 12)
    (box,) = raster.instances(m, 1)
    return raster.contrast(normal, mask, m, box)


def test_contrast_is_signed():
    assert scene(100, 150) == -50.0
    assert scene(200, 150) == 50.0


def test_half_covered_rim_does_not_dilute():
    assert scene(100, 150, rim=(128, 125)) == -50.0


def test_without_full_coverage_the_most_covered_count():
    assert scene(100, 150, alpha=180) == -50.0
    normal, mask = np.full((96, 96, 3), 150, np.uint8), blank(96, 96)
    mask[40:52, 40:52], normal[40:52, 40:52] = 60, 120
    mask[40, 40:48], normal[40, 40:48] = 190, 90
    m = raster.binarise(mask, 12)
    assert raster.contrast(normal, mask, m, raster.instances(m, 1)[0]) == -60.0


def test_neighbour_is_no_background():
    normal, mask = np.full((96, 96, 3), 150, np.uint8), blank(96, 96)
    mask[40:52, 40:52], normal[40:52, 40:52] = 255, 100
    mask[40:52, 56:68], normal[40:52, 56:68] = 255, 10
    m = raster.binarise(mask, 12)
    assert raster.contrast(normal, mask, m, Box(40, 40, 12, 12, 144)) == -50.0


def test_full_frame_cannot_be_measured():
    full = np.full((32, 32, 3), 255, np.uint8)
    m = raster.binarise(full, 12)
    assert raster.contrast(full, full, m, raster.instances(m, 1)[0]) is None


def test_contrast_near_the_object_is_that_of_the_whole_frame():
    draw = np.random.default_rng(9)
    for _ in range(40):
        normal, mask = draw.integers(0, 256, (50, 60, 3), dtype=np.uint8), np.zeros((50, 60, 3), np.uint8)
        y, x, h, w = draw.integers(0, 40), draw.integers(0, 50), draw.integers(1, 20), draw.integers(1, 20)
        mask[y : y + h, x : x + w] = draw.integers(0, 256, mask[y : y + h, x : x + w].shape)
        m = raster.binarise(mask, 32)
        for box in raster.instances(m, 1):
            maps = raster.sampled(raster.coverage(mask), m, box)
            plane = raster.grey(normal)
            want = None if maps is None else float(plane[maps[0]].mean() - plane[maps[1]].mean())
            assert raster.contrast(normal, mask, m, box) == want


def test_ring_reaches_half_its_width():
    assert raster.grown(lit((20, 21, 20, 21)), 7).sum() == 15 * 15
    assert raster.grown(lit((0, 1, 0, 1)), 7).sum() == 8 * 8


def test_tint():
    image = blank(400, 4)
    image[:300, :, 0], image[:300, :, 2], image[300:, :, 2] = 30, 10, 255
    assert raster.sky_tint(image) == 20.0


@pytest.mark.parametrize("channels", [1, 3, 4])
def test_png_is_read_back(spark, tmp_path, channels):
    image = np.random.default_rng(1).integers(0, 256, (5, 7, channels), dtype=np.uint8)
    (tmp_path / "a.png").write_bytes(png.encode(image))
    assert png.size(png.encode(image)) == (7, 5)
    r = spark.read.format("image").load(str(tmp_path)).select("image.*").first()
    assert np.array_equal(np.frombuffer(bytes(r.data), np.uint8).reshape(r.height, r.width, r.nChannels), image)
