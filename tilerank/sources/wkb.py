"""Well-known-binary geometry at file boundaries.

Geometry lives inside the library as plain double columns (points) or segment tables
(lines, polygon rings); WKB is decoded once at ingest and encoded once at egress, in
Arrow batches inside Spark tasks.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT_SCHEMA = T.StructType(
    [
        T.StructField("feature_id", T.StringType()),
        T.StructField("osm_type", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("ring", T.IntegerType()),
        T.StructField("seg", T.IntegerType()),
        T.StructField("lon1", T.DoubleType()),
        T.StructField("lat1", T.DoubleType()),
        T.StructField("lon2", T.DoubleType()),
        T.StructField("lat2", T.DoubleType()),
    ]
)


def _read_points(buf: bytes, off: int, n: int, fmt: str, dims: int):
    pts = struct.unpack_from(fmt + "d" * (n * dims), buf, off)
    xy = [(pts[i * dims], pts[i * dims + 1]) for i in range(n)]
    return xy, off + 8 * n * dims


def _geometry(buf: bytes, off: int = 0):
    """Parse one WKB geometry into ``(kind, part, ring, [points])`` tuples (kind: point, line or
    ring) and return them with the end offset."""
    fmt = "<" if buf[off] == 1 else ">"
    (gtype,) = struct.unpack_from(fmt + "I", buf, off + 1)
    off += 5
    has_srid = bool(gtype & 0x20000000)
    dims = 2 + bool(gtype & 0x80000000) + bool(gtype & 0x40000000)
    gtype &= 0x0FFFFFFF
    if has_srid:
        off += 4
    if gtype >= 1000:  # ISO Z / M / ZM codes
        extra = gtype // 1000
        dims = 2 + (1 if extra in (1, 2) else 2)
        gtype %= 1000
    out = []
    if gtype == 1:
        xy, off = _read_points(buf, off, 1, fmt, dims)
        if not any(np.isnan(v) for v in xy[0]):
            out.append(("point", 0, 0, xy))
    elif gtype == 2:
        (n,) = struct.unpack_from(fmt + "I", buf, off)
        xy, off = _read_points(buf, off + 4, n, fmt, dims)
        out.append(("line", 0, 0, xy))
    elif gtype == 3:
        (nr,) = struct.unpack_from(fmt + "I", buf, off)
        off += 4
        for r in range(nr):
            (n,) = struct.unpack_from(fmt + "I", buf, off)
            xy, off = _read_points(buf, off + 4, n, fmt, dims)
            out.append(("ring", 0, r, xy))
    elif gtype in (4, 5, 6, 7):
        (np_,) = struct.unpack_from(fmt + "I", buf, off)
        off += 4
        for p in range(np_):
            sub, off = _geometry(buf, off)
            out.extend((kind, p, ring, xy) for (kind, _, ring, xy) in sub)
    else:
        raise ValueError(f"unsupported WKB geometry type {gtype}")
    return out, off


def wkb_to_segments(blob: bytes, with_kind: bool = False) -> list[tuple]:
    """Segments ``(part, ring, seg, x1, y1, x2, y2)`` (``kind`` first when asked); a point becomes
    one zero-length segment."""
    rows = []
    parts, _ = _geometry(bytes(blob))
    for kind, part, ring, xy in parts:
        head = (kind, part, ring) if with_kind else (part, ring)
        if len(xy) == 1:
            rows.append(head + (0, xy[0][0], xy[0][1], xy[0][0], xy[0][1]))
        for i in range(len(xy) - 1):
            rows.append(head + (i, xy[i][0], xy[i][1], xy[i + 1][0], xy[i + 1][1]))
    return rows


def decode_segments(batches: Iterator[pd.DataFrame], id_col: str, type_col: str, wkb_col: str) -> Iterator[pd.DataFrame]:
    """``mapInPandas`` body: one output row per segment of each WKB geometry.

    Plain points and lines (little endian, two dimensions) of one length are decoded together, other geometries one by one.
    """
    cols = [f.name for f in SEGMENT_SCHEMA.fields]
    for pdf in batches:
        ids, types = pdf[id_col].to_numpy(dtype=object), pdf[type_col].to_numpy(dtype=object)
        alike: dict[tuple[str, int], list[tuple[int, bytes]]] = {}
        out = []
        for i, blob in enumerate(pdf[wkb_col]):
            if blob is None:
                continue
            shape = _plain(blob)
            if shape is None:
                fid = None if ids[i] is None else str(ids[i])
                out.extend((fid, types[i], *row) for row in wkb_to_segments(blob, with_kind=True))
            else:
                alike.setdefault(shape, []).append((i, blob))
        frames = [_rows_of_alike(kind, n, found, ids, types, cols) for (kind, n), found in alike.items()]
        if out or not frames:
            frames.append(pd.DataFrame(out, columns=cols))
        for frame in frames:
            for c in ("part", "ring", "seg"):
                frame[c] = frame[c].astype("int32")
            yield frame


def _plain(blob: bytes) -> tuple[str, int] | None:
    """(kind, points) of a little-endian point or line of two dimensions, else None."""
    if blob[:5] == b"\x01\x01\0\0\0" and len(blob) == 21:
        return "point", 1
    if blob[:5] == b"\x01\x02\0\0\0" and len(blob) > 25:
        n = int.from_bytes(blob[5:9], "little")
        return ("line", n) if len(blob) == 9 + 16 * n else None
    return None


def _rows_of_alike(kind: str, n: int, found: list[tuple[int, bytes]], ids: np.ndarray, types: np.ndarray, cols: list[str]) -> pd.DataFrame:
    """Segments of geometries of one kind with ``n`` points each."""
    at = np.array([i for i, _ in found])
    head = 5 if kind == "point" else 9
    raw = np.frombuffer(b"".join(b for _, b in found), dtype=np.uint8).reshape(len(found), -1)
    xy = np.ascontiguousarray(raw[:, head:]).view("<f8").reshape(len(found), n, 2)
    if kind == "point":
        kept = ~np.isnan(xy).any(axis=(1, 2))
        at, xy = at[kept], np.repeat(xy[kept], 2, axis=1)
    segs = xy.shape[1] - 1
    names = np.array([None if f is None else str(f) for f in ids[at]], dtype=object)
    zero = np.zeros(len(at) * segs, dtype="int32")
    values = [np.repeat(names, segs), np.repeat(types[at], segs), np.full(len(zero), kind, dtype=object), zero, zero, np.tile(np.arange(segs, dtype="int32"), len(at)),
              xy[:, :-1, 0].ravel(), xy[:, :-1, 1].ravel(), xy[:, 1:, 0].ravel(), xy[:, 1:, 1].ravel()]
    return pd.DataFrame(dict(zip(cols, values)))


def encode_point(x: float, y: float) -> bytes:
    return struct.pack("<BIdd", 1, 1, x, y)


def encode_linestring(xy: list[tuple[float, float]]) -> bytes:
    return struct.pack("<BII", 1, 2, len(xy)) + b"".join(struct.pack("<dd", x, y) for x, y in xy)


def encode_polygon(rings: list[list[tuple[float, float]]]) -> bytes:
    body = b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", x, y) for x, y in r) for r in rings)
    return struct.pack("<BII", 1, 3, len(rings)) + body


@F.pandas_udf(T.BinaryType())
def _point_wkb(x: pd.Series, y: pd.Series) -> pd.Series:
    rec = np.empty(len(x), dtype=[("bo", "u1"), ("t", "<u4"), ("x", "<f8"), ("y", "<f8")])
    rec["bo"], rec["t"], rec["x"], rec["y"] = 1, 1, x.to_numpy(dtype="f8"), y.to_numpy(dtype="f8")
    raw = rec.tobytes()
    return pd.Series([raw[i * 21:(i + 1) * 21] for i in range(len(x))])


@F.pandas_udf(T.BinaryType())
def _linestring_wkb(xs: pd.Series, ys: pd.Series) -> pd.Series:
    return pd.Series([struct.pack("<BII", 1, 2, len(x)) + np.column_stack([x, y]).astype("<f8").tobytes() for x, y in zip(xs, ys)])


def point_wkb(lon: Column | str, lat: Column | str) -> Column:
    """WKB point (little endian) from two coordinate columns, encoded per Arrow batch."""
    return _point_wkb(F.col(lon) if isinstance(lon, str) else lon, F.col(lat) if isinstance(lat, str) else lat)


def linestring_wkb(points: Column) -> Column:
    """WKB linestring from an ``array<struct<x, y>>`` column."""
    return _linestring_wkb(F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"]))
