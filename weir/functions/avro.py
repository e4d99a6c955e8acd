"""Schemaless Avro codec for the fixed stream payload.

Payload record, fields in this order (fixed by the producer):
    user: string, event: string, amount: double, ts: long (epoch millis)
Avro binary: long = zig-zag varint; string = long byte length + UTF-8;
double = 8 bytes little-endian. No container header.

One Arrow-batched pandas UDF decodes all four fields at once (a struct),
not one Python UDF per field, over the batch's buffers with numpy. Where the spark-avro package is on the class
path, `decode_payload(..., builtin=True)` uses the JVM `from_avro` instead.
"""

from __future__ import annotations

import json
import struct
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from weir.schemas import PAYLOAD

# Fixed value: the payload schema shared by producer and consumer.
PAYLOAD_AVSC = json.dumps({
    "type": "record",
    "name": "Event",
    "fields": [
        {"name": "user", "type": "string"},
        {"name": "event", "type": "string"},
        {"name": "amount", "type": "double"},
        {"name": "ts", "type": "long"},
    ],
})

# The codec travels with the UDF (pickled by value), so Python workers need
# no copy of this package to decode.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class CorruptPayload(ValueError):
    pass


def _put_long(out: bytearray, n: int) -> None:
    z = ((n << 1) ^ (n >> 63)) & 0xFFFFFFFFFFFFFFFF
    while z > 0x7F:
        out.append((z & 0x7F) | 0x80)
        z >>= 7
    out.append(z)


def _longs(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The varint at each position and where it ends; one pass per byte of the
    longest, so at most ten."""
    z, at, more = np.zeros(len(at), np.uint64), at.copy(), np.arange(len(at))
    for shift in range(0, 70, 7):
        if not len(more):
            break
        if (at[more] >= end[more]).any():
            raise CorruptPayload("truncated varint")
        b = data[at[more]].astype(np.uint64)
        if shift == 63 and (b > 1).any():
            raise CorruptPayload("overlong varint")
        z[more] |= (b & np.uint64(0x7F)) << np.uint64(shift)
        at[more] += 1
        more = more[b > 0x7F]
    return (z >> np.uint64(1)).view(np.int64) ^ -(z & np.uint64(1)).view(np.int64), at


def _strings(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    n, at = _longs(data, at, end)
    if ((n < 0) | (n > end - at)).any():
        raise CorruptPayload("string runs past the record")
    to = np.concatenate(([0], np.cumsum(n)))
    body = data[np.arange(to[-1]) + np.repeat(at - to[:-1], n)]
    out = pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(to.astype("<i8")), pa.py_buffer(body)])
    out.validate(full=True)  # UTF-8
    return out, at + n


def decode_columns(payloads: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """user, event, amount and ts of a large_binary array without nulls."""
    _, offsets, body = payloads.buffers()
    bounds = np.frombuffer(offsets, "<i8")[payloads.offset:payloads.offset + len(payloads) + 1]
    data = np.frombuffer(body or b"", np.uint8)
    at, end = bounds[:-1], bounds[1:]
    user, at = _strings(data, at, end)
    event, at = _strings(data, at, end)
    if (end - at < 8).any():
        raise CorruptPayload("double runs past the record")
    amount = data[at[:, None] + np.arange(8)].view("<f8").ravel()
    ts, at = _longs(data, at + 8, end)
    if (at != end).any():
        raise CorruptPayload("trailing bytes after the record")
    return user, event, amount, ts


def encode_record(user: str, event: str, amount: float, ts: int) -> bytes:
    out = bytearray()
    for s in (user, event):
        b = s.encode("utf-8")
        _put_long(out, len(b))
        out += b
    out += struct.pack("<d", amount)
    _put_long(out, ts)
    return bytes(out)


def decode_record(buf: bytes) -> tuple[str, str, float, int]:
    user, event, amount, ts = decode_columns(pa.array([buf], pa.large_binary()))
    return user[0].as_py(), event[0].as_py(), float(amount[0]), int(ts[0])


@pandas_udf(T.BinaryType())
def _encode(user: pd.Series, event: pd.Series, amount: pd.Series, ts: pd.Series) -> pd.Series:
    return pd.Series([
        None if (u is None or e is None or a is None or t is None or pd.isna(a) or pd.isna(t))
        else encode_record(u, e, float(a), int(t))
        for u, e, a, t in zip(user, event, amount, ts)
    ], dtype=object)


@pandas_udf(PAYLOAD)
def _decode(value: pd.Series) -> pd.DataFrame:
    # a null payload's struct is null (decode_payload); any record stands in for it here
    payloads = pa.array(value, pa.large_binary()).fill_null(encode_record("", "", 0.0, 0))
    user, event, amount, ts = decode_columns(payloads)
    return pd.DataFrame({"user": user.to_pandas(), "event": event.to_pandas(), "amount": amount, "ts": ts})


def encode_payload(user: Column, event: Column, amount: Column, ts: Column) -> Column:
    """Avro-encode the four payload fields (null field -> null payload)."""
    return _encode(user, event, amount, ts)


def decode_payload(value: Column, builtin: bool = False) -> Column:
    """Binary payload -> struct<user, event, amount, ts>. A null payload
    gives a null struct; a corrupt one fails the task (as the reference's
    reader would)."""
    if builtin:
        from pyspark.sql.avro.functions import from_avro

        return from_avro(value, PAYLOAD_AVSC, {"mode": "FAILFAST"})
    return F.when(value.isNotNull(), _decode(value))
