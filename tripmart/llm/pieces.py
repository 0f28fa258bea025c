"""Operator 5: SentencePiece encoding and decoding by a batched Viterbi search.

The model file's pieces and scores are read once on the driver and broadcast (tens of thousands of
pieces). A text becomes units that no piece crosses: a run of spaces with what follows it, and line
feeds by themselves where no piece holds one. In each chunk the distinct units not met before in
the task are grouped by length; units of equal length advance together, one end position at a time:
the hashes of all substrings that end there probe the sorted piece hashes, and a vectorised maximum
over the substring lengths stores the backpointer.

For a unigram model the maximum is over the sum of the pieces' scores. A model of merges (the
default) has another optimum, the segmentation that its merges lead to: that is the one path on
which every two neighbours stay apart when just their joint characters are merged. So there a step
to a piece is allowed only if the piece before it and the piece itself stay apart, which is looked up
in a table of pairs met so far; the ids are those of the SentencePiece library. Equal values prefer
the longer last piece. Units over ``LONG`` characters go through the same recurrence alone, their
probes in one batch.

A character without a piece is written as its UTF-8 byte pieces (in a unigram model at ``UNKNOWN``
below the least score), so decoding gives back any text exactly; U+2581, which the model uses for a
space, is written as bytes too where a text holds it.

Defined results: null or empty text has no ids and decodes to an empty text. Extra columns are
kept out; repeated rows and null doc_ids each get their own result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm.common import BASE2, U64, Rolling, lists, mapped, mix, powers, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 0x2581  # stands for a space in pieces
LITERAL = 0x110000 + SPACE  # a U+2581 of the text itself
UNKNOWN = 10.0
LONG = 64
KNOWN = 1 << 20  # units that a task remembers
PAIRS = 1 << 20  # slots of the table of pairs
CHUNK = 2 << 20


def apart(text: str, border: int, scores: dict[str, float]) -> bool:
    """Whether merging the characters of ``text`` (best score first, then leftmost) until nothing
    merges gives the pieces text[:border] and text[border:] (one piece if border is 0)."""
    parts = list(text)
    at = list(range(len(parts)))  # where the parts start
    gain = [scores.get(x + y) for x, y in zip(parts, parts[1:])]
    while True:
        best, i = None, -1
        for j, s in enumerate(gain):
            if s is not None and (best is None or s > best):
                best, i = s, j
        if i < 0:
            return len(parts) == (2 if border else 1)
        if at[i + 1] == border:
            return False
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del at[i + 1], gain[i]
        if i:
            gain[i - 1] = scores.get(parts[i - 1] + parts[i])
        if i < len(gain):
            gain[i] = scores.get(parts[i] + parts[i + 1])


def cp_values(cps: np.ndarray) -> np.ndarray:
    return mix(cps.astype(U64) + U64(0x632BE59BD9B4E019))


def unit_hashes(cps: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hashes of the units cps[start[i]:start[i + 1]], which may be of any length."""
    return span_hashes(cps.astype("<u4").view(np.uint8), 4 * start[:-1], 4 * start[1:])


@dataclass
class PieceTable:
    """Pieces by the hash of their characters."""
    keys: np.ndarray  # sorted hashes
    ids: np.ndarray
    scores: np.ndarray
    longest: int
    unknown: float
    byte_ids: np.ndarray  # piece of each byte
    split_lines: bool  # no piece holds a line feed
    filter: np.ndarray  # bitmap of the hashes' low bits
    pool: np.ndarray  # bytes of all ids, spaces written as spaces
    pool_at: np.ndarray
    merges: bool  # a model of merges, else unigram
    texts: list[str]  # by sorted key
    alone: np.ndarray  # the piece's own characters merge to it

    @classmethod
    def load(cls, path: str = MODEL, merges: bool = True) -> PieceTable:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        text, byte_ids, raw = {}, np.zeros(256, dtype=np.int32), []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:-1], 16)] = i
                raw.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                text[i] = piece
                raw.append(piece.replace(chr(SPACE), " ").encode())
        assert not any(chr(SPACE) in p.lstrip(chr(SPACE)) for p in text.values()), "pieces cross words"
        ids = np.fromiter(text, dtype=np.int32)
        cps = np.frombuffer("".join(text.values()).encode("utf-32-le"), dtype=np.uint32)
        at = np.cumsum([0, *map(len, text.values())])
        keys = Rolling(cp_values(cps), BASE2).spans(at[:-1], at[1:])
        scores = np.array([sp.get_score(int(i)) for i in ids])
        order = np.argsort(keys)
        bits = np.zeros(1 << 20, dtype=bool)
        bits[(keys & U64((1 << 20) - 1)).astype(np.int64)] = True
        texts = [text[i] for i in ids[order].tolist()]
        by_text = dict(zip(texts, scores[order].tolist()))
        alone = np.array([not merges or apart(t, 0, by_text) for t in texts])
        return cls(keys[order], ids[order], scores[order], int(np.diff(at).max()), scores.min() - UNKNOWN, byte_ids,
                   not any("\n" in p for p in text.values()), bits, np.frombuffer(b"".join(raw), dtype=np.uint8),
                   np.cumsum([0, *map(len, raw)]), merges, texts, alone)

    def probe(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, position in the sorted keys) of the hashes that are pieces."""
        maybe = np.flatnonzero(self.filter[(hashes & U64((1 << 20) - 1)).astype(np.int64)])
        at = np.searchsorted(self.keys, hashes[maybe])
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == hashes[maybe]
        return maybe[hit], at[hit]


class Pairs:
    """Which pieces may follow each other, with a table of the answers so far."""

    def __init__(self, table: PieceTable):
        self.table = table
        self.scores = dict(zip(table.texts, table.scores.tolist()))
        self.code = np.full(PAIRS, -1, dtype=np.int64)
        self.answer = np.zeros(PAIRS, dtype=bool)

    def allowed(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """For key positions; before: -1 at the start and after an unknown character."""
        out = self.table.alone[piece]
        two = np.flatnonzero(before >= 0)
        code = before[two].astype(np.int64) << 32 | piece[two]
        slot = (mix(code.view(U64)) & U64(PAIRS - 1)).astype(np.int64)
        known = self.code[slot] == code
        out[two[known]] = self.answer[slot[known]]
        if not known.all():
            new, back = np.unique(code[~known], return_inverse=True)
            texts = self.table.texts
            answer = np.array([apart(texts[c >> 32] + texts[c & 0xFFFFFFFF], len(texts[c >> 32]), self.scores)
                               for c in new.tolist()], dtype=bool)
            out[two[~known]] = answer[back]
            self.code[slot[~known]], self.answer[slot[~known]] = code[~known], answer[back]
        return out


def units(data: np.ndarray, at: np.ndarray, split_lines: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points with a space before each text, unit starts with an end mark, first unit of each row)."""
    cps = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32).copy()
    heads = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    cat = heads[at]  # row offsets in characters
    full = np.diff(cat) > 0
    cps[cps == SPACE] = LITERAL
    cps[cps == 32] = SPACE
    cps = np.insert(cps, cat[:-1][full], SPACE)
    cat = cat + np.concatenate([[0], np.cumsum(full)])
    if not len(cps):
        return cps, np.zeros(1, dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    space = cps == SPACE
    start = np.zeros(len(cps), dtype=bool)
    start[0] = True
    start[1:] = space[1:] & ~space[:-1]
    start[cat[:-1][full]] = True
    if split_lines:
        feed = cps == 10
        start |= feed
        start[1:] |= feed[:-1]
    start = np.flatnonzero(start)
    return cps, np.append(start, len(cps)), np.searchsorted(start, cat)


def best_long(pairs: Pairs, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, key positions or -1) of the best pieces of one long unit."""
    table, n = pairs.table, len(values)
    roll = Rolling(values, BASE2)
    options: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]
    for size in range(1, min(n, table.longest) + 1):
        end = np.arange(size, n + 1)
        which, key = table.probe(roll.spans(end - size, end))
        for e, k, s in zip(end[which].tolist(), key.tolist(), table.scores[key].tolist()):
            options[e].append((size, k, s))
    best, back, keys = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    for e in range(1, n + 1):
        top, at, key = -np.inf, e - 1, -1
        fits = options[e]
        if table.merges and fits:
            ok = pairs.allowed(np.array([keys[e - size] for size, _, _ in fits]), np.array([k for _, k, _ in fits]))
            fits = [(size, k, 0.0) for (size, k, _), o in zip(fits, ok.tolist()) if o]
        for size, k, s in fits:
            if best[e - size] + s >= top:
                top, at, key = best[e - size] + s, e - size, k
        if not (options[e] and options[e][0][0] == 1) and best[e - 1] + table.unknown > top:
            top, at, key = best[e - 1] + table.unknown, e - 1, -1
        best[e], back[e], keys[e] = 0.0 if table.merges else top, at, key
    starts, chosen, e = [], [], n
    while e:
        starts.append(back[e])
        chosen.append(keys[e])
        e = back[e]
    return np.array(starts[::-1], dtype=np.int64), np.array(chosen[::-1], dtype=np.int64)


def step(pairs: Pairs, scores: np.ndarray, hashes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
    """One end position of many strings: scores and last pieces [length - 1, string] of the prefixes
    before the last piece, hashes of the last piece; gives the best score, length and key position."""
    table, m = pairs.table, hashes.shape[1]
    which, found = table.probe(hashes.ravel())
    value = np.full(hashes.size, -np.inf)
    value[:m] = scores[0] + table.unknown  # an unknown character; a piece of one character replaces it
    value[which[which < m]] = -np.inf
    if table.merges:
        ok = pairs.allowed(before.ravel()[which], found)
        which, found = which[ok], found[ok]
        value[which] = 0.0
    else:
        value[which] = scores.ravel()[which] + table.scores[found]
    place = np.full(hashes.size, -1, dtype=np.int64)
    place[which] = found
    value = value.reshape(hashes.shape)
    top = len(value) - 1 - value[::-1].argmax(0)  # the longest of equal ones
    each = np.arange(m)
    best = value[top, each]
    return np.zeros(m) if table.merges else best, top + 1, place.reshape(hashes.shape)[top, each]


def best_equal(pairs: Pairs, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Last piece's length and key position (-1: unknown), [end, unit], of units of one length."""
    m, n = values.shape
    p, inverse = powers(BASE2, n + 1)
    sums = np.zeros((n + 1, m), dtype=U64)
    np.cumsum((values * p[:n]).T, axis=0, out=sums[1:])
    best = np.zeros((n + 1, m))
    size, key = np.ones((n + 1, m), dtype=np.int16), np.full((n + 1, m), -1, dtype=np.int64)
    for e in range(1, n + 1):
        spans = np.arange(1, min(e, pairs.table.longest) + 1)
        hashes = mix((sums[e][None] - sums[e - spans]) * inverse[e - spans][:, None]
                     + spans.astype(U64)[:, None] * U64(0xE7037ED1A0B428DB))
        best[e], size[e], key[e] = step(pairs, best[e - spans], hashes, key[e - spans])
    return size, key


class Encoder:
    """Segments units, remembering those of earlier chunks."""

    def __init__(self, table: PieceTable):
        self.table, self.pairs = table, Pairs(table)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=U64)
        self.at = np.zeros(1, dtype=np.int64)  # ids of known unit i: ids[at[i]:at[i + 1]]
        self.ids = np.zeros(0, dtype=np.int32)

    def _ids(self, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """The ids of each unit."""
        t, values = self.table, cp_values(cps)
        out: list = [None] * len(starts)
        unit, key, char = [], [], []  # of every piece, per group in unit order
        length = ends - starts
        for n in np.unique(length).tolist():
            group = np.flatnonzero(length == n)
            if n > LONG:
                for g in group.tolist():
                    s, k = best_long(self.pairs, values[starts[g]:ends[g]])
                    unit.append(np.full(len(s), g))
                    key.append(k)
                    char.append(starts[g] + s)
                continue
            for part in np.array_split(group, max(1, len(group) * n * t.longest // (1 << 22) or 1)):
                size, chosen = best_equal(self.pairs, values[starts[part][:, None] + np.arange(n)])
                e, back = np.full(len(part), n), []
                while (live := np.flatnonzero(e > 0)).size:
                    z = size[e[live], live]
                    back.append((part[live], chosen[e[live], live], starts[part[live]] + e[live] - z))
                    e[live] -= z
                u, k, c = (np.concatenate([b[i] for b in back[::-1]]) for i in range(3))
                order = np.argsort(u, kind="stable")
                unit.append(u[order])
                key.append(k[order])
                char.append(c[order])
        unit, key, char = np.concatenate(unit), np.concatenate(key), np.concatenate(char)
        ids = np.where(key >= 0, t.ids[key], -1)
        if (ids < 0).any():  # bytes of the unknown characters
            new = []
            for i, c in zip(ids.tolist(), cps[char].tolist()):
                new.append([i] if i >= 0 else t.byte_ids[list(chr(SPACE if c == LITERAL else c).encode())].tolist())
            count = np.array([len(x) for x in new])
            ids, unit = np.array([y for x in new for y in x]), np.repeat(unit, count)
        order = np.argsort(unit, kind="stable")
        counts = np.bincount(unit, minlength=len(starts))
        return np.split(ids[order].astype(np.int32), np.cumsum(counts)[:-1])

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per row) of a chunk of texts."""
        cps, start, first = units(data, at, self.table.split_lines)
        if len(start) < 2:
            return np.zeros(0, dtype=np.int32), np.zeros(len(at) - 1, dtype=np.int64)
        hashes = unit_hashes(cps, start)
        code, unique = pd.factorize(hashes)
        where = np.searchsorted(self.known, unique)
        where[where == len(self.known)] = 0
        missing = np.flatnonzero(self.known[where] != unique) if len(self.known) else np.arange(len(unique))
        if len(missing):
            if len(self.known) + len(missing) > KNOWN:
                self._forget()
                missing = np.arange(len(unique))
            example = np.zeros(len(unique), dtype=np.int64)
            example[code[::-1]] = np.arange(len(code))[::-1]
            new = self._ids(cps, start[:-1][example[missing]], start[1:][example[missing]])
            keys = np.concatenate([self.known, unique[missing]])
            pool = np.concatenate([self.ids, *new])
            sizes = np.concatenate([np.diff(self.at), [len(x) for x in new]]).astype(np.int64)
            offsets = np.cumsum(sizes) - sizes
            order = np.argsort(keys)
            self.known, sizes = keys[order], sizes[order]
            self.at = np.concatenate([[0], np.cumsum(sizes)])
            self.ids = gather(pool, offsets[order], sizes)
            where = np.searchsorted(self.known, unique)
        unit = where[code]
        sizes = np.diff(self.at)[unit]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return gather(self.ids, self.at[unit], sizes), np.diff(ends[first])


def gather(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """pool[start:start + size] of all spans, one after another."""
    total = int(size.sum())
    return pool[np.arange(total) + np.repeat(start - (np.cumsum(size) - size), size)]


def decode_bytes(table: PieceTable, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts whose ids are given one after another; the leading space goes."""
    sizes = np.diff(table.pool_at)[ids]
    data = gather(table.pool, table.pool_at[ids], sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = ends[np.concatenate([[0], np.cumsum(counts)])]
    full = np.diff(at) > 0
    data = np.delete(data, at[:-1][full])
    return data, at - np.concatenate([[0], np.cumsum(full)])


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip (the decoded ids are the text's bytes) of every row."""
    table = docs.sparkSession.sparkContext.broadcast(PieceTable.load(path))
    state: dict = {}

    def work(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        t = table.value
        if "encoder" not in state:
            state["encoder"] = Encoder(t)
        ids, counts = state["encoder"].encode(data, at)
        back, back_at = decode_bytes(t, ids, counts)
        if np.array_equal(back, data) and np.array_equal(back_at, at):
            same = np.ones(len(counts), dtype=bool)
        else:
            same = np.array([np.array_equal(back[a:b], data[c:d]) for a, b, c, d in
                             zip(back_at[:-1], back_at[1:], at[:-1], at[1:])], dtype=bool)
        return {"doc_id": rows.column(0), "n_tokens": counts.astype(np.int64),
                "ids": lists(counts, pa.array(ids)), "round_trip": same}

    return mapped(docs.select(docs.doc_id.cast("long").alias("doc_id"), "text"), "text",
                  "doc_id long, n_tokens long, ids array<int>, round_trip boolean", work, CHUNK)


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` (doc_id, ids) with the column text; ids that don't form valid UTF-8 raise."""
    from pyspark.sql import functions as F

    from tripmart.llm.common import in_arrow
    table = encoded.sparkSession.sparkContext.broadcast(PieceTable.load(path))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                ids = part.column(1)
                counts = np.asarray(ids.value_lengths())
                data, at = decode_bytes(table.value, np.asarray(ids.flatten()).astype(np.int64), counts)
                text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [
                    None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), text.cast(pa.large_string()).cast(pa.string())],
                                                 names=["doc_id", "text"])

    return in_arrow(encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")), run,
                    "doc_id long, text string")
