"""Operator 6: removal of line chunks that repeat anywhere in the corpus.

A rolling hash over each line and the one before it marks a chunk's end where it is less than the
rolling hashes of the neighbouring lines; so a boundary depends on four lines only and survives
shifts, and chunks have two lines or more (a text of one line has none). Chunk hashes are counted
over all documents (partial counts before the shuffle). Chunks whose hash occurs more than once are
fetched through a fixed-size bitmap, compared byte by byte with the first occurrence (least doc_id,
then least position), and removed unless they are that first one; the other lines stay as they are.

Such chunks miss the ends of a repeated block and most short blocks. With ``whole_runs`` a second
level follows on the lines that no copied chunk holds, with chunks of two lines, one beginning at
every line: those over the edge of a copied chunk extend it line by line for as long as an earlier
text has the lines too, and the others find short runs. They are counted, fetched and compared in
the same way. So of each run of two or more lines that occurred before, all lines go, wherever the
cuts lie. Nothing is missed by leaving out the pairs inside copied chunks: each has an earlier
occurrence in the chunk's first one, and the earliest of all is never left out. Two blank lines
alone are no repeat, in a copied chunk neither; blank lines left between removed lines (or a text's
border) go with them.

Defined results: null or empty text has one empty line and no chunk (null stays null); rows with a
null doc_id pass unchanged and are no first occurrence; rows that share a doc_id count as one
document at equal positions, so a repeated row loses no more than the row it repeats, and one with
another text only loses what its own lines repeat. A text that
loses all its lines becomes null. Extra columns are kept where ``keep_columns`` asks for it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import (BASE2, NOT_SPACE, U64, Rolling, bitmap, byte_values, in_arrow, in_bitmap, chunks, lines, lists,
                                 mapped, mix, pack, signed, unpack, written)

CHUNK_TYPE = "array<struct<idx:int,h1:long,h2:long>>"


def hashed_lines(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, end, hash) of every line: the costly part of chunks and pairs, made once for both."""
    row, start, end = lines(data, at)
    return row, start, end, Rolling(byte_values(0)[data]).spans(start, end)


def line_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The number of lines of each row."""
    return np.diff(np.searchsorted(np.flatnonzero(data == 10), at)) + 1


def line_chunks(data: np.ndarray, at: np.ndarray, hashed: tuple | None = None) -> dict[str, np.ndarray]:
    """The chunks of two lines or more: row, idx (first line), start and end bytes, hashes. ``hashed`` is the result of
    ``hashed_lines`` where the caller has it."""
    row, start, end, line = hashed or hashed_lines(data, at)
    rolling = mix(line ^ U64(0x3C6EF372FE94F82B))
    same = row[1:] == row[:-1]
    rolling[1:][same] = mix(line[1:][same] + line[:-1][same] * U64(BASE2))
    count = np.bincount(row, minlength=len(at) - 1)
    first = np.cumsum(count) - count
    inner = np.arange(len(row)) - first[row]  # line number within its row
    last = inner == count[row] - 1
    cut = np.zeros(len(row), dtype=bool)
    if len(row) > 2:
        cut[1:-1] = (rolling[1:-1] < rolling[:-2]) & (rolling[1:-1] < rolling[2:])
        cut &= (inner > 0) & (inner < count[row] - 2)  # no chunk of one line at either end
    tail = np.flatnonzero(cut | last)
    head = np.concatenate([[0], tail[:-1] + 1]) if len(tail) else tail
    many = tail > head
    head, tail = head[many], tail[many]
    seq, other = Rolling(line, BASE2), Rolling(mix(line ^ U64(0x510E527FADE682D1)))
    return {"row": row[head], "idx": inner[head], "start": start[head], "end": end[tail], "n": tail - head + 1,
            "h1": seq.spans(head, tail + 1), "h2": other.spans(head, tail + 1)}


def line_pairs(data: np.ndarray, at: np.ndarray, hashed: tuple | None = None) -> dict[str, np.ndarray]:
    """Every two neighbouring lines that are not both blank, as ``line_chunks`` gives its chunks."""
    row, start, end, line = hashed or hashed_lines(data, at)
    count = np.bincount(row, minlength=len(at) - 1)
    inner = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    text = np.concatenate([[0], np.cumsum(NOT_SPACE[data])])
    head = np.flatnonzero((row[1:] == row[:-1]) & (text[end[1:]] > text[start[:-1]]))
    seq, other = Rolling(line, BASE2), Rolling(mix(line ^ U64(0x510E527FADE682D1)))
    return {"row": row[head], "idx": inner[head], "start": start[head], "end": end[head + 1], "n": np.full(len(head), 2),
            "h1": seq.spans(head, head + 2), "h2": other.spans(head, head + 2)}


def _among(found: dict[str, np.ndarray], rows: int, wanted: pa.Array | None) -> np.ndarray:
    """Which of the chunks found in ``rows`` rows are in ``wanted``, a list of (idx, h1) for each row."""
    out = np.zeros(len(found["row"]), dtype=bool)
    if wanted is None or not len(out) or wanted.null_count == rows:
        return out
    row = np.repeat(np.arange(rows), pc.fill_null(pc.list_value_length(wanted), 0).to_numpy(zero_copy_only=False))
    idx, h1 = (x.to_numpy(zero_copy_only=False) for x in wanted.flatten().flatten())
    place = found["row"].astype(np.int64) << 32 | found["idx"]
    want = row.astype(np.int64) << 32 | idx
    k = np.minimum(np.searchsorted(place, want), len(place) - 1)
    out[k[(place[k] == want) & (signed(found["h1"])[k] == h1)]] = True
    return out


def _inside(pairs: dict[str, np.ndarray], data: np.ndarray, at: np.ndarray, copied: pa.Array, hashed: tuple) -> np.ndarray:
    """Which pairs of lines lie in one of the ``copied`` chunks of their row."""
    if copied.null_count == len(copied):
        return np.zeros(len(pairs["row"]), dtype=bool)
    c = line_chunks(data, at, hashed)
    hit = _among(c, len(at) - 1, copied)
    if not hit.any():
        return np.zeros(len(pairs["row"]), dtype=bool)
    c = {name: values[hit] for name, values in c.items()}
    head = c["row"].astype(np.int64) << 32 | c["idx"]
    place = pairs["row"].astype(np.int64) << 32 | pairs["idx"]
    k = np.searchsorted(head, place, "right") - 1
    return (k >= 0) & (place < (head + c["n"] - 1)[k])


def open_pairs(data: np.ndarray, at: np.ndarray, copied: pa.Array) -> dict[str, np.ndarray]:
    """The pairs of neighbouring lines that no copied chunk holds."""
    hashed = hashed_lines(data, at)
    pairs = line_pairs(data, at, hashed)
    free = ~_inside(pairs, data, at, copied, hashed)
    return {name: values[free] for name, values in pairs.items()}


def repeated_chunks(docs: DataFrame, cut=line_chunks, *more: str) -> DataFrame:
    """(doc_id, idx, h1) of the chunks to remove. ``cut`` gets the columns ``more`` beside the texts."""
    def hashes(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        c = cut(data, at, *(rows.column(i) for i in range(2, rows.num_columns)))
        struct = pa.StructArray.from_arrays([pa.array(c["idx"].astype(np.int32)), pa.array(signed(c["h1"])),
                                             pa.array(signed(c["h2"]))], names=["idx", "h1", "h2"])
        return {"doc_id": rows.column(0), "chunks": lists(np.bincount(c["row"], minlength=len(at) - 1), struct)}

    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more)
    found = mapped(named, "text", f"doc_id long, chunks {CHUNK_TYPE}", hashes).select(
        "doc_id", F.explode("chunks").alias("x")).groupBy("x.h1", "x.h2").agg(
        F.min(F.struct("doc_id", "x.idx")).alias("first"), F.max(F.struct("doc_id", "x.idx")).alias("last"))
    repeated = written(found.where("first <> last").select("h1", "h2", "first"), "repeated")
    seen = bitmap(repeated, "h1")

    def fetch(batches):
        for batch in batches:
            for row, end, data, at in chunks(batch.column(1)):
                c = cut(data, at, *(batch.column(i).slice(row, end - row) for i in range(2, batch.num_columns)))
                hit = np.flatnonzero(in_bitmap(seen.value, c["h1"]))
                if not len(hit):
                    continue
                text = [data[a:b].tobytes() for a, b in zip(c["start"][hit].tolist(), c["end"][hit].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row).take(pa.array(c["row"][hit])), pa.array(c["idx"][hit].astype(np.int32)),
                     pa.array(signed(c["h1"][hit])), pa.array(signed(c["h2"][hit])), pa.array(text, pa.binary())],
                    names=["doc_id", "idx", "h1", "h2", "chunk"])

    fetched = in_arrow(named, fetch, "doc_id long, idx int, h1 long, h2 long, chunk binary")
    copies = written(fetched.join(repeated.withColumnRenamed("first", "f"), ["h1", "h2"]), "copies")
    is_first = F.struct("doc_id", "idx") == F.col("f")
    firsts = copies.where(is_first).groupBy("h1", "h2").agg(F.min("chunk").alias("kept"))
    return copies.where(~is_first).join(firsts, ["h1", "h2"]).where("chunk = kept").select("doc_id", "idx", "h1").distinct()


def _with_lists(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """``docs`` with the chunks of ``gone`` as the list ``name``; the text comes last."""
    listed = gone.groupBy(F.col("doc_id").alias("gone_id")).agg(F.collect_list(F.struct("idx", "h1")).alias(name))
    joined = docs.join(listed, F.col("doc_id").cast("long") == F.col("gone_id"), "left").drop("gone_id")
    return joined.select(*[c for c in joined.columns if c != "text"], "text")


def dedup_lines(docs: DataFrame, keep_columns: bool = False, whole_runs: bool = False) -> DataFrame:
    """Every row of ``docs``: doc_id (or all columns, as row_), text (null if all lines went),
    n_lines and n_removed. ``whole_runs`` adds the level of two lines to that of the chunks."""
    what = pack(docs, "doc_id", "text") if keep_columns else docs.select("doc_id", "text")
    if keep_columns:
        what = what.select(F.col("row_").dropFields("text").alias("row_"), "doc_id", "text")
    out = what.drop("text").schema
    joined = _with_lists(what, repeated_chunks(docs), "copied")
    if whole_runs:
        joined = written(joined, "chunked")
        joined = _with_lists(joined, repeated_chunks(joined, open_pairs, "copied"), "pairs")
    width = len(out)

    def run(batches):
        for batch in batches:
            for a, b, data, at in chunks(batch.column(batch.num_columns - 1)):
                part = batch.slice(a, b - a)
                text = part.column(part.num_columns - 1)
                total = line_counts(data, at)
                removed = np.zeros(b - a, dtype=np.int64)
                if any(part.column(i).null_count < b - a for i in range(width, part.num_columns - 1)):
                    if whole_runs:
                        hashed = hashed_lines(data, at)
                        c = line_pairs(data, at, hashed)
                        gone = _inside(c, data, at, part.column(width), hashed) | _among(c, b - a, part.column(width + 1))
                    else:
                        c = line_chunks(data, at)
                        gone = _among(c, b - a, part.column(width))
                    new = text.to_pylist()
                    spans: dict[int, list[tuple[int, int]]] = {}
                    for r, s, e in zip(*(c[k][gone].tolist() for k in ("row", "start", "end"))):
                        spans.setdefault(r, []).append((s, e))
                    for r, cuts in spans.items():
                        kept, upto = [], int(at[r])
                        for s, e in cuts:
                            if s > upto:
                                kept.append(data[upto:s - 1].tobytes())
                            upto = e + 1
                        if upto <= at[r + 1]:
                            kept.append(data[upto:at[r + 1]].tobytes())
                        if whole_runs:
                            kept = [x for x in kept if x.strip()]
                        removed[r] = total[r] - sum(x.count(b"\n") + 1 for x in kept)
                        new[r] = b"\n".join(kept).decode() if kept else None
                    text = pa.array(new, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(width)), text.cast(pa.string()), pa.array(total), pa.array(removed)],
                    names=[*(f.name for f in out), "text", "n_lines", "n_removed"])

    schema = type(out)([*out.fields]).add("text", "string").add("n_lines", "long").add("n_removed", "long")
    return in_arrow(joined, run, schema)


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns and the new texts (n_chars follows); rows that lost every line go."""
    got = dedup_lines(docs, keep_columns=True).where("n_removed = 0 OR text IS NOT NULL")
    if "n_chars" not in docs.columns:
        return unpack(got, docs)
    size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row_.n_chars")).cast(docs.schema["n_chars"].dataType)
    return got.select(*[F.col("text") if c == "text" else size.alias(c) if c == "n_chars" else
                        F.col("row_").getField(c).alias(c) for c in docs.columns])
