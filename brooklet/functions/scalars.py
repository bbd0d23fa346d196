"""Column functions. All but ``java_hash`` are built from Spark's own expressions and stay inside the JVM."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.arrow_udf(T.IntegerType())
def _hash_units(texts: pa.Array) -> pa.Array:
    """All strings of a batch at once: their UTF-16 units one after the other, times powers of 31 modulo 2^32."""
    strings = texts.to_pylist()
    encoded = [(s or "").encode("utf-16-le", "surrogatepass") for s in strings]
    sizes = np.array([len(e) // 2 for e in encoded], dtype=np.int64)
    units = np.frombuffer(b"".join(encoded), dtype="<u2").astype(np.uint32)
    ends = np.cumsum(sizes)
    steps = np.full(int(sizes.max(initial=0)) + 1, 31, dtype=np.uint32)
    steps[0] = 1
    powers = np.cumprod(steps, dtype=np.uint32)
    sums = np.zeros(len(units) + 1, dtype=np.uint32)
    np.cumsum(units * powers[np.repeat(ends, sizes) - np.arange(len(units)) - 1], dtype=np.uint32, out=sums[1:])
    hashes = (sums[ends] - sums[ends - sizes]).view(np.int32)
    return pa.array(hashes, mask=texts.is_null().to_numpy(zero_copy_only=False))


def java_hash(text: Column) -> Column:
    """32-bit string hash ``h = 31 * h + unit`` over UTF-16 units, as a signed int."""
    return _hash_units(text.cast("string"))


def key_partition(key: Column, partitions: int) -> Column:
    """Partition number of a string key, never negative."""
    return F.pmod(java_hash(key), F.lit(partitions))


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def parse_ts(text: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp of ``text``, null where it does not parse."""
    return F.try_to_timestamp(text, F.lit(fmt))


def format_ts(ts: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(ts, fmt)


def from_epoch(value: Column, unit: str = "s") -> Column:
    """Timestamp of an epoch number in seconds or milliseconds."""
    return F.timestamp_seconds(value) if unit == "s" else F.timestamp_millis(value.cast("long"))


def md5_hex(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def json_path(doc: Column, path: str) -> Column:
    """Nested JSON field as a string, e.g. ``json_path(col, "common.mid")``."""
    return F.get_json_object(doc, "$." + path)


def range_label(start_ms: Column, end_ms: Column) -> Column:
    return F.concat(start_ms.cast("string"), F.lit("--"), end_ms.cast("string"))


def space_split(text: Column) -> Column:
    """Split on single spaces. Empty strings at the end are dropped, inner ones kept; a blank text of no
    characters is one empty string, one of spaces is none."""
    body = F.rtrim(text)
    return F.when((text != "") & (body == ""), F.array().cast("array<string>")).otherwise(F.split(body, " ", -1))
