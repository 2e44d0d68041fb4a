"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from bondmart.session import checkpoint_dir


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers, once per application, so that
    they find it wherever the driver runs. Spark serves the archive from the
    driver, where it stays until the driver ends."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="bondmart-code-"), f"{package.name}-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}-{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage
    and survives a lost executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def byte_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of a string column, None for null."""
    return column(batch, name).cast(pa.binary()).to_pylist()


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to about ``limit``; an item
    over the limit is a range of its own."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def portions(batch: pa.RecordBatch, limit: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text (see ``chunks``)."""
    for a, b in chunks(pc.fill_null(pc.binary_length(column(batch, name)), 0).to_pylist(), limit):
        yield batch.slice(a, b - a)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of several texts in one buffer, each
    followed by one space: ``data[start[i]:end[i]]`` is word i of text ``doc[i]``."""

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        space = _SPACE[joined]
        before = np.empty_like(space)
        before[0], before[1:] = True, space[:-1]
        first = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        self.doc = np.searchsorted(first, np.flatnonzero(before & ~space), side="right")
        clean = np.where(space, np.uint8(0x20), joined)[~(before & space)]
        self.data = clean.tobytes()
        self.bytes = clean
        self.end = np.flatnonzero(clean == 0x20)
        self.start = np.empty_like(self.end)
        if len(self.end):
            self.start[0], self.start[1:] = 0, self.end[:-1] + 1


SLICE_BYTES = 1 << 19
BASE, INVERSE = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
_POWERS = {BASE: np.ones(1, dtype=np.uint64), INVERSE: np.ones(1, dtype=np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and doubled as needed."""
    p = _POWERS[base]
    while len(p) < n:
        p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
    if len(p) <= 1 << 23:
        _POWERS[base] = p
    return p[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's last steps)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hash(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start[i]:start[i+1]] for every i; the last span
    ends with the data. Worked in slices, as it needs 16 bytes a byte."""
    out = np.empty(len(start), dtype=np.uint64)
    edges = np.append(start, len(data))
    first = 0
    while first < len(start):
        past = max(first + 1, int(np.searchsorted(edges, edges[first] + SLICE_BYTES, side="right")) - 1)
        begin = edges[first]
        own = start[first:past] - begin
        part = data[begin:edges[past]].astype(np.uint64) + np.uint64(1)
        part *= powers(BASE, len(part))
        out[first:past] = np.add.reduceat(part, own) * powers(INVERSE, len(part))[own]
        first = past
    return mix(out)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values; by doubling, so log k passes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    mult, out, size, power = 0xD1342543DE82EF95, None, 0, h
    width = 1
    while True:
        if k & width:
            if out is None:
                out, size = power, width
            else:  # the part already taken comes first
                m = len(power) - size
                out = out[:m] * np.uint64(pow(mult, width, 1 << 64)) + power[size:]
                size += width
        if width * 2 > k:
            break
        power = power[:-width] * np.uint64(pow(mult, width, 1 << 64)) + power[width:]
        width *= 2
    return mix(out[:n])


def sliding_min(a: np.ndarray, k: int) -> np.ndarray:
    """Minimum of every k consecutive values."""
    n, width = len(a) - k + 1, 1
    if n <= 0:
        return a[:0]
    while width * 2 <= k:
        a = np.minimum(a[:-width], a[width:])
        width *= 2
    rest = k - width
    return np.minimum(a[:n], a[rest:rest + n])
