"""GeoTIFF files: round trips, planned partitions, overviews."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

from geolith.sources import geotiff

AFFINE = (30.0, 0.0, 500_000.0, 0.0, -30.0, 4_600_000.0)


def grid(dtype, height=70, width=93):
    return (np.arange(height * width).reshape(height, width) * 7 % 251).astype(dtype)


@pytest.mark.parametrize("dtype", ["u1", "<i2", "<u2", "<i4", "<f4", "<f8"])
@pytest.mark.parametrize(("tile", "compress"), [(None, False), (32, False), (16, True)])
def test_round_trip(dtype, tile, compress):
    z = grid(dtype)
    data = geotiff.encode(z, AFFINE, 32634, nodata=9, tile=tile, rows=13, compress=compress, overviews=2)
    for level, want in ((0, z), (1, None), (2, None)):
        h = geotiff.read_header(lambda at, n: data[at : at + n], level)
        back = np.zeros((h.height, h.width))
        for n, i, j, rows in h.blocks():
            part = h.decode(data[h.offsets[n] : h.offsets[n] + h.sizes[n]], rows)[:, : h.width - j]
            back[i : i + rows, j : j + part.shape[1]] = part
        assert h.nodata == 9 and h.affine[2::3] == (500_000.0, 4_600_000.0)
        assert (h.height, h.width) == [(70, 93), (35, 47), (18, 24)][level]
        if want is not None:
            assert (back == want).all() and h.affine == AFFINE
        elif level == 1 and np.dtype(dtype).kind == "f":
            assert np.allclose(back[:, :46], z[:, :92].astype(float).reshape(35, 2, 46, 2).mean((1, 3)))


def test_big_endian_and_turned_files():
    """A file of the other byte order, with a whole matrix in place of scale and tie point and a horizontal predictor."""
    import struct

    z = np.array([[1, 5, 2], [7, 7, 9]], ">u2")
    packed = np.diff(z, axis=1, prepend=np.zeros((2, 1), ">u2")).astype(">u2").tobytes()
    matrix = (0.0, 2.0, 0.0, 10.0, 3.0, 0.0, 0.0, 20.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)
    at = 8 + len(packed)
    fields = [(256, 3, 1, 3), (257, 3, 1, 2), (258, 3, 1, 16), (259, 3, 1, 1), (273, 4, 1, 8), (278, 3, 1, 2), (279, 4, 1, len(packed)), (317, 3, 1, 2), (34264, 12, 16, at + 2 + 9 * 12 + 4)]
    data = b"MM\0*" + struct.pack(">I", at) + packed + struct.pack(">H", len(fields))
    for tag, kind, n, v in fields:
        data += struct.pack(">HHI", tag, kind, n) + (struct.pack(">HH", v, 0) if kind == 3 else struct.pack(">I", v))
    data += struct.pack(">I", 0) + struct.pack(">16d", *matrix)
    h = geotiff.read_header(lambda a, n: data[a : a + n])
    assert (h.decode(data[8 : 8 + len(packed)], 2) == z).all() and h.affine == (0.0, 2.0, 10.0, 3.0, 0.0, 20.0)
    with pytest.raises(ValueError):
        geotiff.read_header(lambda a, n: b"GIF89a"[a : a + n])


@pytest.fixture
def file(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(geotiff.encode(grid("<i2"), AFFINE, 32634, nodata=0, tile=16, overviews=1))
    (tmp_path / "other.txt").write_text("no raster")
    return tmp_path


def test_cells_and_places(spark, file):
    z = grid("<i2")
    for path in (str(file), f"file://{file}/a.tif"):
        rows = geotiff.geotiff(spark, path, cells=600).collect()
        assert len(rows) == z.size
        assert all(r["z"] == (None if z[r["i"], r["j"]] == 0 else z[r["i"], r["j"]]) for r in rows)
        assert all(r["x"] == 500_000 + 30 * (r["j"] + 0.5) and r["y"] == 4_600_000 - 30 * (r["i"] + 0.5) for r in rows)
    low = geotiff.geotiff(spark, str(file), level=1)
    assert low.count() == 35 * 47 and low.filter("i = 0 AND j = 0").first()["x"] == pytest.approx(500_000 + 15 * 93 / 47)


def test_blocks_outside_of_a_filter_are_not_planned(spark, file):
    def planned(*filters):
        reader = geotiff.TiffReader(str(file), 0, 1)
        assert list(reader.pushFilters(list(filters))) == list(filters)
        return sum(len(p.value[2]) for p in reader.partitions()), len(reader.partitions())

    assert planned() == (30, 30)
    assert planned(GreaterThanOrEqual(("i",), 32), LessThan(("i",), 48)) == (6, 6)
    assert planned(EqualTo(("i",), 20), EqualTo(("j",), 92)) == (1, 1)
    assert planned(In(("j",), (3, 17)), LessThan(("i",), 16)) == (2, 2)
    assert planned(EqualTo(("i",), 1000)) == (0, 0)
    assert planned(EqualTo(("z",), 3)) == (30, 30)
    near = geotiff.geotiff(spark, str(file), cells=1).filter((F.col("i") >= 35) & (F.col("i") < 40) & (F.col("j") == 50))
    assert near.rdd.getNumPartitions() == 1 and near.count() == 5
