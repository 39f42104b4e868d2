"""Fixed binary layouts as numpy types, and their encoding and decoding a batch at a time."""

from __future__ import annotations

import numpy as np

#: Fixed layouts, little-endian. Placed objects take 152 bytes, airports 72, an overview's header 36.
OBJECT = np.dtype([("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("scale", "<f4"), ("heading", "<f4"), ("size", "u1"), ("name", "S131")])
AIRPORT = np.dtype([
    ("size", "u1"), ("name", "S31"), ("zero", "<f4"), ("lat", "<f4"), ("lon", "<f4"), ("elevation", "<f4"), ("direction", "<i4"), ("length", "<i4"), ("width", "<i4"),
    ("flags", "<u4"), ("frequency", "<f4"), ("kind", "<u4"),
])
OVERVIEW = np.dtype([("width", "<i4"), ("height", "<i4"), ("steps", "<f4", 3), ("east", "<f4"), ("north", "<f4"), ("zone", "<u2"), ("pad1", "<u2"), ("hemisphere", "<u2"), ("pad2", "<u2")])
#: Values a side of a height patch, a side of a forest patch; kind of an airport.
HEIGHT_SIDE, FOREST_SIDE, AIRPORT_KIND = 193, 512, 0x100
STEPS = (90.0, -90.0, 90.0)


def records(layout: np.dtype, columns: dict[str, np.ndarray]) -> np.ndarray:
    """Rows of a layout; `size` becomes the length of the name, which is cut to fit and made ASCII."""
    out = np.zeros(len(next(iter(columns.values()))), layout)
    for key, values in columns.items():
        if key == "name":
            room = layout["name"].itemsize
            names = [str(v).encode("ascii", "ignore")[:room] for v in values]
            out["name"], out["size"] = names, [len(n) for n in names]
        else:
            out[key] = values
    return out


def names(rows: np.ndarray) -> list[str]:
    return [n[:k].decode("ascii") for n, k in zip(rows["name"].tolist(), rows["size"].tolist(), strict=True)]


def decode_records(layout: np.dtype, content: bytes) -> np.ndarray:
    if len(content) % layout.itemsize:
        raise ValueError(f"{len(content)} bytes are no whole number of records of {layout.itemsize}")
    return np.frombuffer(content, layout)


def encode_patch(values: np.ndarray, kind: str = "<u2") -> bytes:
    """A square patch, mirrored about its other diagonal as the files hold it."""
    return np.ascontiguousarray(values.T[::-1, ::-1]).astype(kind).tobytes()


def decode_patch(content: bytes, side: int, kind: str = "<u2") -> np.ndarray:
    values = np.frombuffer(content, kind)
    if len(values) != side * side:
        raise ValueError(f"{len(values)} values are not {side} x {side}")
    return values.reshape(side, side).T[::-1, ::-1]


def encode_overview(values: np.ndarray, east: float, north: float, zone: int) -> bytes:
    """Header and rows from south to north; row 0 of values is the northern one."""
    head = np.zeros(1, OVERVIEW)
    head["width"], head["height"], head["steps"], head["east"], head["north"], head["zone"], head["hemisphere"] = values.shape[1], values.shape[0], STEPS, east, north, zone, ord("N")
    return head.tobytes() + values[::-1].astype("<u2").tobytes()


def decode_overview(content: bytes) -> tuple[np.void, np.ndarray]:
    head = np.frombuffer(content[: OVERVIEW.itemsize], OVERVIEW)[0]
    shape = int(head["height"]), int(head["width"])
    if len(content) != OVERVIEW.itemsize + 2 * shape[0] * shape[1]:
        raise ValueError("the size differs from the header's")
    return head, np.frombuffer(content[OVERVIEW.itemsize :], "<u2").reshape(shape)[::-1]


def encode_bytes_map(values: np.ndarray) -> bytes:
    """Width and height, then a byte for each cell."""
    return np.array(values.shape[::-1], "<i4").tobytes() + values.astype("u1").tobytes()


def decode_bytes_map(content: bytes) -> np.ndarray:
    width, height = np.frombuffer(content[:8], "<i4").tolist()
    if len(content) != 8 + width * height:
        raise ValueError("the size differs from the header's")
    return np.frombuffer(content[8:], "u1").reshape(height, width)


def decode_heights(content: bytes, width: int, height: int) -> np.ndarray:
    """Headerless 16-bit heights, row 0 in the north; values below 0 (no data) become 0."""
    values = np.frombuffer(content, "<i2")
    if len(values) != width * height:
        raise ValueError(f"{len(values)} samples are not {width} x {height}")
    return np.maximum(values, 0).reshape(height, width)
