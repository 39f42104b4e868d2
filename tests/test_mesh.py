import numpy as np
import pytest

from geolith.sources import mesh


def test_models(spark):
    v, i = mesh.prism([(0, 0), (4, 0), (4, 3), (0, 3)], 2.0)
    content = mesh.encode([("haus", "a.png", v, i, [1.0] * 6), ("é", "", v + 1, i[:6], [0.5] * 6)])
    found, vertices, indices = mesh.decode(content)
    assert found == [("haus", "a.png", 0, 8, 0, 30), ("é", "", 8, 8, 30, 6)] and len(vertices) == 16 and indices[30:].min() >= 8
    assert mesh.decode(mesh.encode([]))[0] == []
    files = spark.createDataFrame([("m", bytearray(content))], "path STRING, content BINARY")
    assert [(r["name"], r["first_vertex"]) for r in mesh.objects(files).orderBy("place").collect()] == [("haus", 0), ("é", 8)]
    alone = spark.createDataFrame([("m", bytearray(mesh.encode([("haus", "", v, i, [1.0] * 6)])))], "path STRING, content BINARY")
    assert [tuple(r) for r in mesh.surface_area(mesh.triangles(alone)).collect()] == [("m", 10, 2 * (4 + 3) * 2 + 12.0)]
    sizes = spark.createDataFrame([("m", 0, 8, 30), ("m", 1, 8, 6), ("k", 0, 3, 3)], "file STRING, place INT, vertices INT, indices INT")
    assert sorted((r["file"], r["place"], r["first_vertex"], r["first_index"]) for r in mesh.offsets(sizes).collect()) == [("k", 0, 0, 0), ("m", 0, 0, 0), ("m", 1, 8, 30)]


def test_damage():
    v, i = mesh.prism([(0, 0), (1, 0), (0, 1)], 1.0)
    with pytest.raises(ValueError):
        mesh.encode([("a", "", v, np.array([99]), [0.0] * 6)])
    with pytest.raises(ValueError):
        mesh.decode(mesh.encode([("a", "", v, i, [0.0] * 6)]) + b"x")
    with pytest.raises(ValueError):
        mesh.decode(b"nothing")


def test_odd_records_and_pools_in_another_order():
    """Records with longer materials and padding between them, at any place in the words, and parts of the pool in another order than the objects."""
    shapes = [mesh.prism([(0, 0), (k + 1, 0), (0, 2)], 1.0 + k) for k in range(4)]
    objects = [(f"object {k}", "t.png" * k, v + k, i, [float(k)] * 6) for k, (v, i) in enumerate(shapes)]
    for order in (None, [2, 0, 3, 1]):
        content = mesh.encode(objects, order)
        found, vertices, indices = mesh.decode(content)
        assert [f[0] for f in found] == [o[0] for o in objects]
        for (name, texture, a, n, b, m), (_, skin, v, i, _) in zip(found, objects):
            assert texture == skin and (vertices[a : a + n] == v.astype("f4")).all() and (indices[b : b + m] - a == i).all()
        pool = mesh.find_pool(content)[0]
        for pad in (1, 2, 3, 30):
            for name in (b"object 1", b"object 3"):
                at = content.index(name) - 4
                odd = content[:at] + b"\xff" * pad + content[at:]
                again = mesh.decode(odd)
                assert again[0] == found and (again[1] == vertices).all() and (again[2] == indices).all()
            odd = content[:pool] + b"\x07" * pad + content[pool:]
            assert mesh.decode(odd)[0] == found
    with pytest.raises(ValueError, match="not there"):
        mesh.decode(content.replace(b"object 2", b"object\x00\x00"))
