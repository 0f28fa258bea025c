"""Operator 9: removal of byte strings that occur in an earlier document, by suffix arrays.

Every ``LENGTH``-byte string has a minimizer, the least hash of its ``GRAM``-byte grams; consecutive
strings of a text with the same minimizer form a segment, and equal strings have equal minimizers. So
the suffix array of the corpus is built in parts that never need each other: one string per
minimizer, of its distinct segments, each part by linear grouping (``suffix_array``), many parts
advancing together in a task. Neighbouring suffixes that share ``LENGTH`` bytes form a run, and a run's
least doc_id is the first document of its string. Each document then loses the bytes covered by
strings whose first document is smaller.

What keeps it linear: texts that are wholly equal to a smaller document's are removed as such and
take no further part; minimizers that occur once are dropped by counting them; of equal segments one
goes on, with its least doc_id; a minimizer with one distinct segment needs no suffix array, as all
its strings have the same documents, and neither does a segment that shares no longer string around
the minimizer; a minimizer with more than ``HOT`` distinct segments is split
into its single strings, whose least doc_id is a grouped minimum. Filters sized by their keys thin what
is moved; joins decide. Segments are told apart by minimizer and content hash, 64 bits each, strings by their bytes.
Texts are compressed one by one where they are shuffled to their cuts; shuffles and written tables go with their last reader.

Defined results: null or empty text has no bytes; texts under ``LENGTH`` bytes stay; rows with a null
doc_id have no order, lose nothing and are no source; a doc_id names one text, repeated rows of it get
the same result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import (U64, Rolling, Scratch, bitmap, byte_values, chunks, in_arrow, in_bitmap, in_filter, key_filter,
                                 only, ship, signed, sliding_min)
from tripmart.llm.suffix_array import suffix_array, suffix_arrays
from tripmart.session import shuffles_freed

LENGTH = 50
GRAM = 24
HOT = 5_000  # distinct segments of one minimizer that still share a suffix array
PART_BYTES = 1_500_000  # of segments in one task's group
BATCH_BYTES = 600_000  # of strings whose suffix arrays advance together
TOGETHER = 60  # ... if they are this many times the longest one
CHUNK = 1 << 18
MARK = 0xFF  # between segments; no byte of UTF-8


def segments(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Segments of a chunk: row, start and end (bytes of the chunk), minimizer, content hash."""
    roll = Rolling(byte_values(3)[data])
    n = len(data) - LENGTH + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return {"row": none, "start": none, "end": none, "m": none.view(U64), "h": none.view(U64)}
    least = sliding_min(roll.windows(GRAM), LENGTH - GRAM + 1)
    new = np.ones(n, dtype=bool)
    new[1:] = least[1:] != least[:-1]
    new[at[:-1][at[:-1] < n]] = True
    start = np.flatnonzero(new)
    row = np.searchsorted(at, start, "right") - 1
    stop = at[row + 1] - LENGTH + 1  # behind the row's last string
    whole = start < stop
    start, row, stop = start[whole], row[whole], stop[whole]
    stop = np.minimum(np.append(start[1:], n), stop)
    end = stop + LENGTH - 1
    return {"row": row, "start": start, "end": end, "m": least[start], "h": roll.spans(start, end)}


def chosen(batch: pa.RecordBatch, known) -> pa.RecordBatch:
    """The rows whose doc_id, the first column, may be in a bitmap."""
    return batch.filter(pa.array(in_bitmap(known.value, batch.column(0).to_numpy().view(U64))))


def minimizers(docs: DataFrame, known) -> DataFrame:
    """(m) of every segment of every text whose doc_id may be in a bitmap."""
    def run(batches):
        for batch in batches:
            for _, _, data, at in chunks(chosen(batch, known).column(1), CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array(signed(segments(data, at)["m"]))], names=["m"])

    return in_arrow(docs.select("doc_id", "text"), run, "m long")


def occurrences(docs: DataFrame, known, shared) -> DataFrame:
    """(h, m, doc_id, start, len) of their segments whose minimizer may be shared."""
    def run(batches):
        for batch in batches:
            batch = chosen(batch, known)
            for first, end, data, at in chunks(batch.column(1), CHUNK):
                s = segments(data, at)
                keep = in_filter(shared.value, s["m"])
                row, start = s["row"][keep], s["start"][keep]
                ids = batch.column(0).slice(first, end - first).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(s["h"][keep])), pa.array(signed(s["m"][keep])), ids,
                     pa.array((start - at[row]).astype(np.int32)), pa.array((s["end"][keep] - start).astype(np.int32))],
                    names=["h", "m", "doc_id", "start", "len"])

    return in_arrow(docs.select("doc_id", "text"), run, "h long, m long, doc_id long, start int, len int")


def packed(docs: DataFrame, known) -> DataFrame:
    """(doc_id, size, packed) of the texts whose doc_id may be in a bitmap, each compressed by itself."""
    def run(batches):
        pack = pa.Codec("zstd", 1)
        for batch in batches:
            batch = chosen(batch, known)
            text = [t.as_buffer() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t.size for t in text], pa.int64()),
                 pa.array([pack.compress(t, asbytes=True) for t in text], pa.binary())], names=["doc_id", "size", "packed"])

    return in_arrow(docs.select("doc_id", "text"), run, "doc_id long, size long, packed binary")


def unpacked(size: pa.Array, text: pa.Array) -> list[bytes]:
    pack = pa.Codec("zstd")
    return [pack.decompress(t.as_buffer(), n, asbytes=True) for n, t in zip(size.to_pylist(), text)]


def fetch(docs: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """``wanted`` (m, h, d, e, segments, start, len) with the bytes of each segment, cut from its document d."""
    lists_ = scratch.written(wanted.groupBy("d").agg(F.collect_list(F.struct("m", "h", "e", "segments", "start", "len")).alias("cuts")), "cuts")

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 100):
                part = batch.slice(i, 100)
                text = unpacked(part.column(1), part.column(2))
                cuts = part.column(3)
                count = np.asarray(pa.compute.list_value_length(cuts))
                each = np.repeat(np.arange(len(text)), count).tolist()
                x = cuts.flatten()
                start, size = x.field("start").to_pylist(), x.field("len").to_pylist()
                raw = [text[k][a:a + n] for k, a, n in zip(each, start, size)]
                yield pa.RecordBatch.from_arrays(
                    [x.field("m"), x.field("h"), part.column(0).take(pa.array(each, pa.int64())), x.field("e"), x.field("segments"),
                     pa.array(raw, pa.binary())], names=["m", "h", "d", "e", "segments", "segment"])

    joined = packed(docs, bitmap(lists_, "d")).join(lists_, F.col("doc_id") == F.col("d")).select("doc_id", "size", "packed", "cuts")
    return in_arrow(joined, run, "m long, h long, d long, e long, segments long, segment binary")


def alike(text: np.ndarray, at: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether a segment text[at[i]:at[i + 1] - 1] may share a string with another of its minimizer:
    around a shared minimizer, a shared string has half of its other bytes at least on one side."""
    side = (LENGTH - GRAM + 1) // 2
    roll = Rolling(byte_values(3)[text])
    segment = np.repeat(np.arange(len(m)), np.diff(at))[:max(0, len(text) - GRAM + 1)]
    place = np.flatnonzero(roll.windows(GRAM) == m.view(U64)[segment])
    segment = segment[place]
    keys, owners = [], []
    for a, b, key in ((place - side, place + GRAM, 1), (place, place + GRAM + side, 2)):
        inside = (a >= at[segment]) & (b < at[segment + 1])
        keys.append(roll.spans(a[inside], b[inside]) ^ m.view(U64)[segment[inside]] * U64(2 * key + 1))
        owners.append(segment[inside])
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    twin = (key[1:] == key[:-1]) & (owner[1:] != owner[:-1])
    out = np.zeros(len(m), dtype=bool)
    out[owner[1:][twin]] = out[owner[:-1][twin]] = True
    # Owners between two others of a key are covered from either side; repeats within one owner are not twins.
    return out


def first_documents(text: np.ndarray, at: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of segments text[at[i]:at[i + 1] - 1] (each ends in a mark), ordered by group: (segment, from, to,
    least doc) of the strings that start at from, ..., to - 1, by the suffix array of each group."""
    cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    strings = np.append(at[cut], len(text))
    if len(text) >= TOGETHER * int(np.diff(strings).max()):
        order = suffix_arrays(text, strings)
    else:  # few long strings: a step for all of them would hold little work
        order = np.concatenate([np.array(suffix_array(text[a:b].tobytes()), dtype=np.int64) + a
                                for a, b in zip(strings[:-1].tolist(), strings[1:].tolist())])
    segment = np.repeat(np.arange(len(group)), np.diff(at))
    order = order[order + LENGTH < at[segment[order] + 1]]
    words = np.ascontiguousarray(np.concatenate([text, np.zeros(8, dtype=np.uint8)]))
    words = np.ndarray((len(text) + 1,), dtype=np.uint64, buffer=words.tobytes(), strides=(1,))
    same = group[segment[order[1:]]] == group[segment[order[:-1]]]
    for k in (0, 8, 16, 24, 32, 40, LENGTH - 8):
        v = words[order + k]
        same &= v[1:] == v[:-1]
    if not len(order):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    run = np.concatenate([[0], np.cumsum(~same)])
    least = np.minimum.reduceat(doc[segment[order]], np.flatnonzero(np.concatenate([[True], ~same])))
    back = np.argsort(order)
    position, least = order[back], least[run[back]]
    segment = segment[position]
    new = np.concatenate([[True], (segment[1:] != segment[:-1]) | (least[1:] != least[:-1])])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(position)) - 1
    return segment[head], position[head] - at[segment[head]], position[tail] + 1 - at[segment[head]], least[head]


def suffix_runs(parts: DataFrame, total_bytes: int) -> DataFrame:
    """(m, h, from, to, doc) for rows (m, h, d, e, segment): minimizer, hash, first and last document and bytes;
    only strings whose first document is before e."""
    n_parts = 1 + int(total_bytes) // PART_BYTES

    def run(table: pa.Table) -> pa.Table:
        m, h, d, e = (table.column(c).to_numpy() for c in ("m", "h", "d", "e"))
        size = np.asarray(pa.compute.binary_length(table.column("segment").combine_chunks())).astype(np.int64) + 1
        _, group = np.unique(m, return_inverse=True)
        weight = np.bincount(group, weights=size)  # strings of similar length advance together
        order = np.lexsort((group, weight[group]))
        raw = table.column("segment").take(pa.array(order)).to_pylist()
        m, h, d, e, group, size = m[order], h[order], d[order], e[order], group[order], size[order]
        at = np.concatenate([[0], np.cumsum(size)])
        text = np.frombuffer(bytes([MARK]).join(raw) + bytes([MARK]), dtype=np.uint8)
        near = alike(text, at, m)
        lone = np.flatnonzero(~near)
        out = [(lone, np.zeros(len(lone), dtype=np.int64), size[lone] - LENGTH, d[lone])]
        near = np.flatnonzero(near)
        ends = np.flatnonzero(np.concatenate([group[near][1:] != group[near][:-1], [True]])) + 1
        sums = np.concatenate([[0], np.cumsum(size[near])])
        a = 0
        while a < len(near):
            b = int(np.searchsorted(sums, sums[a] + BATCH_BYTES))
            b = int(ends[min(np.searchsorted(ends, max(b, a + 1)), len(ends) - 1)])
            chosen = near[a:b]
            part = np.frombuffer(bytes([MARK]).join([raw[i] for i in chosen.tolist()]) + bytes([MARK]), dtype=np.uint8)
            got = first_documents(part, np.concatenate([[0], np.cumsum(size[chosen])]), group[chosen], d[chosen])
            out.append((chosen[got[0]], *got[1:]))
            a = b
        which, start, stop, doc = (np.concatenate([o[i] for o in out]) for i in range(4))
        useful = doc < e[which]
        return pa.table([pa.array(m[which[useful]]), pa.array(h[which[useful]]), pa.array(start[useful].astype(np.int32)),
                         pa.array(stop[useful].astype(np.int32)), pa.array(doc[useful])], names=["m", "h", "from", "to", "doc"])

    ship(parts)
    return parts.withColumn("part", F.pmod(F.xxhash64("m"), F.lit(n_parts))).groupBy("part").applyInArrow(
        run, "m long, h long, from int, to int, doc long")


def single_strings(parts: DataFrame, scratch: Scratch) -> DataFrame:
    """The same, string by string, for minimizers with very many distinct segments."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                rows = batch.slice(i, 500).to_pylist()
                out = [(r["m"], r["h"], p, r["d"], r["e"], r["segment"][p:p + LENGTH]) for r in rows for p in range(len(r["segment"]) - LENGTH + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                     pa.array([x[2] for x in out], pa.int32()), pa.array([x[3] for x in out], pa.int64()),
                     pa.array([x[4] for x in out], pa.int64()), pa.array([x[5] for x in out], pa.binary())],
                    names=["m", "h", "from", "d", "e", "string"])

    strings = scratch.written(in_arrow(parts.select("m", "h", "d", "e", "segment"), run,
                                       "m long, h long, from int, d long, e long, string binary"), "strings")
    least = strings.groupBy("string").agg(F.min("d").alias("doc"))
    return strings.join(least, "string").where("doc < e").select("m", "h", "from", (F.col("from") + 1).alias("to"), "doc")


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_removed, n_spans and kept_sha256 of the documents (id) with lists of strings (gone: from, to) to remove."""
    def run(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                text = np.frombuffer(unpacked(batch.column(1).slice(i, 1), batch.column(2).slice(i, 1))[0], dtype=np.uint8)
                column = batch.column(3).slice(i, 1).flatten()
                change = np.zeros(len(text) + 1, dtype=np.int64)
                np.add.at(change, column.field("from").to_numpy(), 1)
                np.add.at(change, column.field("to").to_numpy(), -1)
                gone_at = np.cumsum(change)[:-1] > 0
                heads = int(gone_at[:1].sum()) + int((gone_at[1:] & ~gone_at[:-1]).sum())
                out.append((batch.column(0)[i].as_py(), int(gone_at.sum()), heads, hashlib.sha256(text[~gone_at].tobytes()).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.string())],
                names=["doc_id", "n_removed", "n_spans", "kept_sha256"])

    joined = packed(docs, bitmap(spans, "id")).join(spans, F.col("doc_id") == F.col("id")).select("doc_id", "size", "packed", "gone")
    return in_arrow(joined, run, "doc_id long, n_removed long, n_spans long, kept_sha256 string").dropDuplicates(["doc_id"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scratch = Scratch(docs.sparkSession)
    with shuffles_freed(docs.sparkSession):
        base, rest = parts_kept(docs, scratch)
    return base.join(rest, "doc_id", "left").select(
        "doc_id", "n_bytes", F.expr("CASE WHEN copy THEN n_bytes ELSE coalesce(n_removed, 0) END").alias("n_removed"),
        F.expr("CASE WHEN copy THEN 1L ELSE coalesce(n_spans, 0) END").alias("n_spans"),
        F.expr("CASE WHEN copy THEN sha2('', 256) ELSE coalesce(kept_sha256, sha) END").alias("kept_sha256"))


def parts_kept(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Written: doc_id, n_bytes, sha and copy of every row, and what ``cut`` gives for the documents that lose strings."""
    written = scratch.written
    base = written(docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "texts")
    first = base.where("doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("first"))
    base = written(base.join(first, "sha", "left").withColumn(
        "copy", F.expr(f"coalesce(first < doc_id, false) AND n_bytes >= {LENGTH}")), "base")
    scratch.drop("texts")
    texts = docs.where(f"doc_id IS NOT NULL AND octet_length(text) >= {LENGTH}")
    known = bitmap(base.where(f"NOT copy AND doc_id IS NOT NULL AND n_bytes >= {LENGTH}"), "doc_id")  # tested where texts are read

    shared = written(minimizers(texts, known).groupBy("m").agg(F.count("*").alias("n")).where("n > 1").select("m"), "shared")
    keys = key_filter(shared, "m", shared.count())
    scratch.drop("shared")
    found = written(occurrences(texts, known, keys), "occurrences")
    keys.destroy()
    distinct = written(found.groupBy("m", "h").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.max("doc_id").alias("e"),
                                                   F.max("len").alias("len"))
                       .select("m", "h", F.col("first.doc_id").alias("d"), "first.start", "e", "len"), "distinct")
    sizes = written(distinct.groupBy("m").agg(F.count("*").alias("segments"), F.min("d").alias("low"), F.max("e").alias("high"))
                    .where("low < high").select("m", "segments"), "sizes")
    keys = key_filter(sizes, "m", sizes.count())
    distinct = written(only(distinct, "m", keys, in_filter).join(sizes, "m"), "segments")
    keys.destroy()
    scratch.drop("distinct", "sizes")
    several = distinct.where("segments > 1")
    got = written(fetch(texts, several, scratch), "fetched")
    scratch.drop("cuts")
    total = several.agg(F.sum("len")).first()[0] or 0
    runs = suffix_runs(got.where(f"segments <= {HOT}"), total)
    runs = runs.union(single_strings(got.where(f"segments > {HOT}"), scratch))
    runs = runs.union(distinct.where("segments = 1").select("m", "h", F.lit(0).alias("from"), (F.col("len") - LENGTH + 1).alias("to"),
                                                            F.col("d").alias("doc")))
    runs = written(runs, "runs")
    scratch.drop("segments", "fetched", "strings")
    keys = key_filter(runs, "h", runs.count())
    gone = only(found.select("m", "h", "doc_id", "start"), "h", keys, in_filter).join(runs, ["m", "h"]).where("doc < doc_id").select(
        "doc_id", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to") + (LENGTH - 1)).alias("to"))
    spans = written(gone.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("from", "to")).alias("gone")), "spans")
    keys.destroy()
    scratch.drop("occurrences", "runs")
    rest = written(cut(texts, spans), "cut")
    scratch.drop("spans")
    return base, rest
