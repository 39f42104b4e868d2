"""Feature collections cut at any place, and compressed textures."""

import json
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from geolith.sources import collections, textures


def collection(n, seed, indent=None):
    """Names hold braces, brackets, quotes and backslashes; keys come in any order; other objects stand around the list."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        ring = [[k, 0], [k + 1, 0], [k + 1, 1], [k, 0]] if k % 5 else [[k, 0], [k, 0], [k, 0], [k, 0]]
        body = {"properties": {"name": '{["\\ }' * rng.randrange(4) + "é日", "k": str(k)}, "geometry": {"type": "Polygon", "coordinates": [ring]} if k % 7 else None, "type": "Feature" if k % 11 else "Other"}
        keys = list(body)
        rng.shuffle(keys)
        out.append({key: body[key] for key in keys})
    return json.dumps({"type": "FeatureCollection", "crs": {"properties": {"name": "x}]"}}, "features": out, "links": [{"type": "no feature", "list": [{}]}]}, ensure_ascii=False, indent=indent)


def rows(d):
    return sorted((r["properties"]["k"], r["properties"]["name"], r["kind"], r["coordinates"]) for r in d.collect())


@pytest.mark.parametrize("indent", [None, 2])
def test_equal_rows_for_any_number_of_splits(spark, tmp_path, indent):
    text = collection(120, 3, indent)
    path = tmp_path / "a.geojson"
    path.write_text(text)
    whole = rows(collections.split_features(spark, str(path), 1 << 30))
    kept = [f for f in json.loads(text)["features"] if f["type"] == "Feature" and f["geometry"]]
    assert [r[:2] for r in whole] == sorted((f["properties"]["k"], f["properties"]["name"]) for f in kept)
    for parts in (2, 16):
        assert rows(collections.split_features(spark, str(path), -(-len(text.encode()) // parts))) == whole
    loaded = collections.loaded_polygons(collections.split_features(spark, str(path), 5000), lambda x, y: (x * 2, y + 10))
    got = {r["properties"]["k"]: [(p["x"], p["y"]) for p in r["ring"]] for r in loaded.collect()}
    assert got == {f["properties"]["k"]: [(2 * x, y + 10) for x, y in f["geometry"]["coordinates"][0][:-1]] for f in kept if int(f["properties"]["k"]) % 5}


def test_collections_of_a_folder_and_empty_ones(spark, tmp_path):
    (tmp_path / "a.json").write_text(collection(0, 1))
    (tmp_path / "b.json").write_text(collection(9, 2))
    (tmp_path / "c.json").write_text("")
    assert collections.split_features(spark, str(tmp_path), 40).count() == len([k for k in range(9) if k % 7 and k % 11])


def test_ranges_that_begin_in_strings_and_after_backslashes(tmp_path):
    data = collection(25, 4).encode()
    path = tmp_path / "a.json"
    path.write_bytes(data)
    for split in (3, 17, 100):
        inside, depth, found = False, 0, []
        for at in range(0, len(data), split):
            escaped = collections._escaped_first(str(path), at)
            cut, _ = collections.features_in(data[at:], min(split, len(data) - at), escaped, inside, depth)
            found += [json.loads(data[at + a : at + b]) for a, b in cut]
            quotes, out, ins = collections.summary(data[at : at + split], escaped)
            inside, depth = inside != bool(quotes), depth + (ins if inside else out)
        assert (inside, depth) == (False, 0)
        assert [f["properties"]["k"] for f in found if "properties" in f] == [str(k) for k in range(25)]


def texture(height, width, kind, seed):
    n = -(-height // 4) * -(-width // 4)
    data = np.random.default_rng(seed).bytes(n * textures.KINDS[kind][0])
    head = bytearray(textures.HEADER)
    head[:4], head[84:88] = b"DDS ", kind
    struct.pack_into("<II", head, 12, height, width)
    return bytes(head) + data, data


def one_pixel(block, kind, p):
    """Red, green, blue and alpha of one pixel, by the format's rules."""
    at = textures.KINDS[kind][1]
    a, b, bits = struct.unpack_from("<HHI", block, at)
    rgb = lambda c: [(c >> 11) * 8 + (c >> 13), (c >> 5 & 63) * 4 + (c >> 9 & 3), (c & 31) * 8 + (c >> 2 & 7)]
    c, x, y = bits >> 2 * p & 3, rgb(a), rgb(b)
    if a > b or kind != b"DXT1":
        colour = [x, y, [(2 * s + t) // 3 for s, t in zip(x, y)], [(s + 2 * t) // 3 for s, t in zip(x, y)]][c]
    else:
        colour = [x, y, [(s + t) // 2 for s, t in zip(x, y)], [0, 0, 0]][c]
    if kind == b"DXT1":
        return [*colour, 0 if a <= b and c == 3 else 255]
    return [*colour, (int.from_bytes(block[:8], "little") >> 4 * p & 15) * 17]


@pytest.mark.parametrize(("kind", "height", "width"), [(b"DXT1", 24, 40), (b"DXT3", 16, 12), (b"DXT1", 10, 7)])
def test_textures_pixel_by_pixel(spark, tmp_path, kind, height, width):
    whole, data = texture(height, width, kind, 5)
    (tmp_path / "t.dds").write_bytes(whole + b"more, smaller images")
    got = {(r["i"], r["j"]): [r["r"], r["g"], r["b"], r["a"]] for r in textures.pixels(spark, str(tmp_path), 2).collect()}
    size, across = textures.KINDS[kind][0], -(-width // 4)
    assert len(got) == height * width
    for (i, j), colour in got.items():
        n = i // 4 * across + j // 4
        assert colour == one_pixel(data[n * size : (n + 1) * size], kind, i % 4 * 4 + j % 4)


def test_textures_of_a_wrong_size_or_kind(spark, tmp_path):
    whole, _ = texture(16, 16, b"DXT1", 6)
    (tmp_path / "t.dds").write_bytes(whole[:-1])
    with pytest.raises(ValueError, match="too short"):
        textures.pixels(spark, str(tmp_path))
    (tmp_path / "t.dds").write_bytes(b"DDS " + bytes(200))
    with pytest.raises(ValueError, match="no texture"):
        textures.pixels(spark, str(tmp_path))
    none = spark.createDataFrame([(1, None), (2, b"short")], "k INT, block BINARY")
    assert textures.block_pixels(none, "block").select(F.count(F.lit(1))).first()[0] == 0
