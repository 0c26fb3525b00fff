"""WKB <-> shape struct. Decoding and encoding walk bytes, which Spark SQL
cannot express, so both are Arrow-batched pandas UDFs (one call per batch,
NumPy ``frombuffer`` for the coordinate arrays)."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from punktwerk.functions.geom import GEOM_T

# WKB geometry type codes (OGC simple features).
WKB_TYPES = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT",
             5: "MULTILINESTRING", 6: "MULTIPOLYGON"}
# Flag bits of the extended form (height, measure, reference system).
Z_FLAG, M_FLAG, SRID_FLAG = 0x80000000, 0x40000000, 0x20000000
WKB_CODES = {v: k for k, v in WKB_TYPES.items()}


def _read_geom(buf: bytes, pos: int):
    order = "<" if buf[pos] == 1 else ">"
    code = struct.unpack_from(order + "I", buf, pos + 1)[0]
    pos += 5
    if code & SRID_FLAG:
        pos += 4
    # further ordinates: as flags, or as thousands of the type code
    flagged = (code & Z_FLAG != 0) + (code & M_FLAG != 0)
    code &= 0x0FFFFFFF
    width = 2 + (flagged or {0: 0, 1: 1, 2: 1, 3: 2}[code // 1000])
    gtype = WKB_TYPES[code % 1000]

    def pts(n, p):
        a = np.frombuffer(buf, dtype=np.dtype(order + "f8"), count=width * n, offset=p).reshape(n, width)
        return [{"x": float(v[0]), "y": float(v[1])} for v in a], p + 8 * width * n

    def rings(p):
        nr = struct.unpack_from(order + "I", buf, p)[0]
        p += 4
        out = []
        for _ in range(nr):
            n = struct.unpack_from(order + "I", buf, p)[0]
            r, p = pts(n, p + 4)
            out.append(r)
        return out, p

    if gtype == "POINT":
        r, pos = pts(1, pos)
        parts = [[r]] if not np.isnan(r[0]["x"]) else []
    elif gtype == "LINESTRING":
        n = struct.unpack_from(order + "I", buf, pos)[0]
        r, pos = pts(n, pos + 4)
        parts = [[r]]
    elif gtype == "POLYGON":
        rs, pos = rings(pos)
        parts = [rs]
    else:
        n = struct.unpack_from(order + "I", buf, pos)[0]
        pos += 4
        parts = []
        for _ in range(n):
            _, sub, pos = _read_geom(buf, pos)
            parts.extend(sub)
    return gtype, parts, pos


def decode_wkb(buf: bytes | None):
    if buf is None:
        return None
    try:
        gtype, parts, _ = _read_geom(bytes(buf), 0)
        return {"gtype": gtype, "parts": parts}
    except Exception:  # malformed input -> null geometry
        return None


def encode_wkb(g) -> bytes | None:
    if g is None:
        return None
    gtype, parts = g["gtype"], g["parts"]
    out = bytearray()

    def ring_bytes(r):
        a = np.array([[v["x"], v["y"]] for v in r], dtype="<f8")
        return struct.pack("<I", len(r)) + a.tobytes()

    def single(kind, part):
        b = bytearray(struct.pack("<BI", 1, WKB_CODES[kind]))
        if kind == "POINT":
            v = part[0][0]
            b += struct.pack("<dd", v["x"], v["y"])
        elif kind == "LINESTRING":
            b += ring_bytes(part[0])
        else:
            b += struct.pack("<I", len(part)) + b"".join(ring_bytes(r) for r in part)
        return bytes(b)

    if gtype in ("POINT", "LINESTRING", "POLYGON"):
        if len(parts) == 0 and gtype == "POINT":
            return struct.pack("<BIdd", 1, 1, float("nan"), float("nan"))
        return single(gtype, parts[0])
    sub = gtype[5:]
    out += struct.pack("<BII", 1, WKB_CODES[gtype], len(parts))
    for p in parts:
        out += single(sub, p)
    return bytes(out)


def _decode_batch(s: pd.Series) -> pd.Series:
    # JSON text, parsed on the JVM side by from_json: nested lists of
    # structs do not survive pandas -> Arrow conversion reliably
    import json
    return pd.Series([json.dumps(r) if r is not None else None for r in (decode_wkb(b) for b in s)])


def _encode_batch(s: pd.Series) -> pd.Series:
    # the shape arrives as JSON text: ragged nested arrays do not survive
    # Arrow -> pandas conversion reliably
    import json
    return pd.Series([encode_wkb(json.loads(t)) if t is not None else None for t in s])


_UDFS: dict = {}


def _udf(name):
    # built on first use on the driver (Python workers only unpickle them)
    from punktwerk.session import ship_package
    ship_package()
    if name not in _UDFS:
        from pyspark.sql.types import BinaryType, StringType
        if name == "decode":
            _UDFS[name] = F.pandas_udf(_decode_batch, StringType())
        else:
            _UDFS[name] = F.pandas_udf(_encode_batch, BinaryType())
    return _UDFS[name]


def st_geomfromwkb(col) -> Column:
    """WKB bytes -> shape struct (null for malformed input)."""
    return F.from_json(_udf("decode")(F.col(col) if isinstance(col, str) else col), GEOM_T)


def st_asbinary(col) -> Column:
    """Shape struct -> little-endian WKB bytes."""
    g = F.col(col) if isinstance(col, str) else col
    return _udf("encode")(F.when(g.isNotNull(), F.to_json(g)))
