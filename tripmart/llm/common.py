"""Helpers shared by the operators: table reads, scratch tables, vectorised text hashing.

Text is handled as UTF-8 bytes straight from Arrow buffers. A chunk of documents is one byte
array; words, windows and byte strings are hashed by differences of prefix sums (a polynomial
hash modulo 2**64), so the cost per byte does not depend on the window length. Chunks hold about
``CHUNK`` bytes (one longer document makes a chunk of its own), which bounds a task's memory.
"""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import drop_scratch, scratch_dir

CHUNK = 1 << 19
BATCH_ROWS = 1_000  # rows per Arrow batch: a few MB of documents, on both sides of the pipe
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd multipliers of the polynomial hashes
BASE2 = 0xD6E8FEB86659FD93

#: Bytes that make up words, fixed by the contracts: everything but ASCII white space, and
#: letters, digits and non-ASCII characters only.
SPACES = np.array([b in (0x20, *range(0x09, 0x0E)) for b in range(256)])
NOT_SPACE = ~SPACES
ALNUM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
INSIDE = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U64)  # of a block, the first n bytes
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables of one job, by name: ``written`` as above, ``drop`` removes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        self.paths[name] = scratch_dir(self.spark, name)
        df.write.parquet(self.paths[name])
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def drop(self, *names: str) -> None:
        for name in names:
            drop_scratch(self.spark, self.paths.pop(name))


_SHIPPED: set[str] = set()


def ship(df: DataFrame) -> None:
    """Send this package to the executors and set the Arrow batch size, once per application."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="tripmart-code-"), "tripmart_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(str(path))
        df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        _SHIPPED.add(context.applicationId)


def in_arrow(df: DataFrame, work: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package on the executors."""
    ship(df)
    return df.mapInArrow(work, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> U64(31))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(29)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(32)
    return x


@functools.cache
def byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F + 2 * seed))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least; kept for the worker's next chunk."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = max(n, CHUNK + (CHUNK >> 2))
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=U64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[base] = both[0], both[1]
    return _POWERS[base]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans data[start:end] of bytes, of any lengths. The eight-byte blocks of all spans are mixed at once,
    then neighbours are joined, level by level; no step is linear, so unlike sums of powers no texts collide by their build."""
    size = (end - start).astype(np.int64)
    count = np.maximum((size + 7) >> 3, 1)
    first = np.cumsum(count) - count
    at = (np.arange(count.sum()) - np.repeat(first, count)) * 8 + np.repeat(start, count)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    block = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))[at]
    left = np.clip(np.repeat(end, count) - at, 0, 8)
    h = mix(block & INSIDE[left])
    out, which = np.empty(len(size), dtype=U64), np.arange(len(size))
    while len(which):
        done = count == 1
        out[which[done]] = h[first[done]]
        which, count, first = which[~done], count[~done], first[~done]
        more = (count + 1) >> 1
        begin = np.cumsum(more) - more
        nth = np.arange(more.sum()) - np.repeat(begin, more)
        one = np.repeat(first, more) + 2 * nth
        other = np.where(2 * nth + 1 < np.repeat(count, more), h[np.minimum(one + 1, len(h) - 1)], U64(0))
        h = mix(h[one] * U64(0x9E3779B97F4A7C15) + mix(other ^ U64(0xC2B2AE3D27D4EB4F)))
        count, first = more, begin
    return mix(out + size.astype(U64) * U64(0xE7037ED1A0B428DB))


class Rolling:
    """Hashes of any spans of ``values`` (uint64) from prefix sums. Powers modulo 2**64 cancel in some texts of 2,048 values
    or more made of two values; so long spans of bytes take ``span_hashes``, and spans here are windows of few values."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        n = len(values)
        p, self.inverse = powers(base, n + 1)
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(values * p[:n], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start]
                   + (end - start).astype(U64) * U64(0xE7037ED1A0B428DB))

    def windows(self, k: int) -> np.ndarray:
        """Hash of every k consecutive values."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, dtype=U64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.inverse[:n])


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    if not len(column):
        return
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield row, end, data[at[row]:at[end]], at[row:end + 1] - at[row]
        row = end


class Words:
    """Words of a chunk: byte spans ``start``/``end``, ``first`` (index of each row's first word,
    with an end mark) and their hashes. ``letters`` says which bytes make up words."""

    def __init__(self, data: np.ndarray, at: np.ndarray, letters: np.ndarray, lower: bool):
        self.data = LOWER[data] if lower else data
        inside = letters[data]
        starts, ends = inside.copy(), inside.copy()
        if len(data):
            starts[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            inner = at[(at > 0) & (at < len(data))]
            starts[inner] |= inside[inner]
            ends[inner - 1] |= inside[inner - 1]
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        return Rolling(byte_values(0)[self.data]).spans(self.start, self.end)

    @functools.cached_property
    def keys(self) -> np.ndarray:
        """Hashes that tell words of any length apart (``hashes`` are those of a polynomial)."""
        return span_hashes(self.data, self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def row_windows(counts: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, first index) of each k consecutive items that lie within one row."""
    per = np.maximum(counts - k + 1, 0)
    row = np.repeat(np.arange(len(counts)), per)
    return row, np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + first[:-1][row]


def lines(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of every \\n-separated line; a row without text has one empty line."""
    n = len(at) - 1
    breaks = np.flatnonzero(data == 10)
    row = np.concatenate([np.searchsorted(at, breaks, "right") - 1, np.arange(n)])
    end = np.concatenate([breaks, at[1:]])
    order = np.lexsort((end, row))
    row, end = row[order], end[order]
    start = np.empty_like(end)
    if len(end):
        start[0] = at[0]
        start[1:] = np.where(row[1:] == row[:-1], end[:-1] + 1, at[row[1:]])
    return row, start, end


def mapped(df: DataFrame, text: str, schema, work: Callable[..., dict[str, pa.Array | np.ndarray | list]],
           size: int = CHUNK) -> DataFrame:
    """``work(rows, data, at)`` on chunks of the column ``text``; it returns the columns of ``schema``,
    as Arrow arrays of the right type (passed on as they are) or as numpy arrays or lists."""
    out = df.sparkSession.createDataFrame([], schema).schema
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    kinds = {f.name: kinds.get(f.dataType.simpleString()) for f in out}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = batch.schema.get_field_index(text)
            for row, end, data, at in chunks(batch.column(where), size):
                got = work(batch.slice(row, end - row), data, at)
                cols = [got[name] if isinstance(got[name], pa.Array) else pa.array(got[name], kind)
                        for name, kind in kinds.items()]
                yield pa.RecordBatch.from_arrays(cols, names=list(kinds))

    return in_arrow(df, run, out)


def lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list column from items per row and all items."""
    at = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), values)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def pack(df: DataFrame, *more) -> DataFrame:
    """All columns of ``df`` as the struct ``row_``, beside ``more``: no clash with helper columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row_"), *more)


def unpack(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` again, from ``row_`` and the column text."""
    return df.select(*[F.col("text") if c == "text" else F.col("row_").getField(c).alias(c) for c in like.columns])


BITS = 25  # a bitmap has 2**25 bits, 4 MB, whatever it is made of


def bitmap(df: DataFrame, column: str):
    """A broadcast bitmap of the low bits of a long column's values. Its size is fixed; a fuller
    one only lets more through to the exact join that follows."""
    slot = F.col(column).bitwiseAND((1 << BITS) - 1)
    words = df.select(F.shiftright(slot, 6).alias("w"), F.expr(f"shiftleft(1L, cast(`{column}` & 63 AS INT))").alias("b")
                      ).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    bits = np.zeros(1 << (BITS - 6), dtype=np.int64)
    bits[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return df.sparkSession.sparkContext.broadcast(bits.view(U64))


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = values & U64((1 << BITS) - 1)
    return (bits[(slot >> U64(6)).astype(np.int64)] >> (slot & U64(63))) & U64(1) != 0


MOST_BITS = 29  # of a filter sized by its keys: 64 MB


def key_filter(df: DataFrame, column: str, n: int):
    """A broadcast filter of a column of n hashes, with eight bits a key at least (up to ``MOST_BITS`` in all) and two of them
    set, in one word: up to 67 million keys it lets some 2 to 6 % of other keys through, however many there are."""
    size = min(max(BITS, (8 * n).bit_length()), MOST_BITS) - 6
    bit = "shiftleft(1L, cast(shiftright(`{0}`, {1}) & 63 AS INT))"
    words = df.select(F.col(column).bitwiseAND((1 << size) - 1).cast("int").alias("w"),
                      F.expr(f"{bit.format(column, 23)} | {bit.format(column, 29)}").alias("b")
                      ).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    bits = np.zeros(1 << size, dtype=np.int64)
    for batch in words.to_batches():
        bits[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return df.sparkSession.sparkContext.broadcast(bits.view(U64))


def in_filter(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Not the high bits: those of minimizers are mostly zeros."""
    want = (U64(1) << (values >> U64(23) & U64(63))) | (U64(1) << (values >> U64(29) & U64(63)))
    return bits[(values & U64(len(bits) - 1)).astype(np.int64)] & want == want


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every w consecutive values, by doubling."""
    span = 1
    while 2 * span <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return x if span == w else np.minimum(x[:len(x) - (w - span)], x[w - span:])


def only(df: DataFrame, column: str, bits, inside: Callable = in_bitmap) -> DataFrame:
    """The rows of ``df`` whose long column may be in a bitmap (or, with ``in_filter``, in a filter); never too few."""
    where = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = pc.is_valid(batch.column(where))
            values = pc.fill_null(batch.column(where), 0).to_numpy().view(U64)
            yield batch.filter(pc.and_(known, pa.array(inside(bits.value, values))))

    return in_arrow(df, run, df.schema)
