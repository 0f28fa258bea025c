"""Operator 2: near-duplicate documents by SetSketch registers.

Each document's set of k-word shingles is reduced to registers: the minimum of a hash over the set,
on an exponential scale with base ``BASE_B`` and truncated to 16 bits. Registers of a union are the
register-wise maxima (minima of the hashes), and two documents agree in a register with a
probability that grows with their Jaccard similarity. Bands of registers give candidates; the joint
likelihood of the registers and the known set sizes rejects hopeless ones (below ``exp(-REJECT)`` of
the maximum at the threshold); the rest is confirmed on the full sets of both texts.

Documents with equal sets form one class and only its least doc_id goes on, so copies cost one row.
A band value shared by many documents does not emit their pairs. In ``STAR_ROUNDS`` rounds every
document is compared with one leader: of the band values that it shares with documents of another
component, the leader that it meets most often. Those that still share a band value with another component then go
through an exact join: with shingles ordered by the number of these documents that hold them, rarest
first, two sets with the wanted overlap share one among their first few (prefix filtering), and its
places in both orders bound the overlap from above (position filtering). Documents of one component
don't meet there; shingles that only one component holds are left out before anything is joined. So the
join's rows follow the rare shingles that documents share, not the squares of their groups. No pair of
a shared band value is left out: a link is missed only where no band agrees, (1 - J**4)**25 or 1e-8 at
a similarity of 0.85, or where the likelihood rejects it (below ``exp(-REJECT)`` of the maximum; none of
20,000 pairs at the threshold in the tests).

Defined results: null, empty or blank text has no shingles and is linked with nothing; fewer words
than a shingle make one shingle; rows with a null doc_id are never linked (component null, kept);
repeated rows of one doc_id get the same component. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import (BASE2, CHUNK, NOT_SPACE, U64, Rolling, Words, bitmap, chunks, in_arrow, in_bitmap, mapped, mix,
                                 only, pack, row_windows, signed, written)
from tripmart.llm.components import components

BASE_B = 1.02  # base of the exponential scale
SCALE_A = 20.0  # rate of the exponential minima
REJECT = 16.0
STAR_ROUNDS = 2


@dataclass(frozen=True)
class NearDup:
    words: int = 5
    percent: int = 80  # 100 * intersection >= percent * union
    band_rows: int = 4
    bands: int = 32

    @property
    def registers(self) -> int:
        return self.band_rows * self.bands


def shingles(data: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, ordered by row, then hash."""
    w = Words(data, at, NOT_SPACE, lower=True)
    counts = w.counts()
    seq = Rolling(w.keys, BASE2)
    row, first = row_windows(counts, w.first, k)
    value = seq.spans(first, first + k)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        row = np.concatenate([row, short])
        value = np.concatenate([value, seq.spans(w.first[short], w.first[short + 1])])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def register_scale(least: np.ndarray) -> np.ndarray:
    """Least 64-bit hashes to registers: floor(1 - log_b(h)) of the exponential h, truncated."""
    h = -np.log1p(-(least.astype(np.float64) + 1) / 2.0**64 * (1 - 1e-16)) / SCALE_A
    k = np.floor(1 - np.log(np.maximum(h, 1e-300)) / np.log(BASE_B))
    return np.clip(k + 1000, 0, 65535).astype(np.uint16)  # shifted: sets of one shingle are at about 0


def sketch(docs: DataFrame, how: NearDup) -> DataFrame:
    """One row a document: doc_id, n (set size), h1/h2 (digest of the set) and registers."""
    factors = mix(np.arange(1, how.registers + 1, dtype=U64) * U64(0x9FB21C651E98DF25)) | U64(1)
    shift = mix(factors ^ U64(0xC2B2AE3D27D4EB4F))

    def work(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        n = len(at) - 1
        row, value = shingles(data, at, how.words)
        size = np.bincount(row, minlength=n)
        full = np.flatnonzero(size)
        digest = np.zeros((2, n), dtype=U64)
        registers = np.zeros((len(full), how.registers), dtype=np.uint16)
        if len(full):
            starts = (np.cumsum(size) - size)[full]
            for i, seed in enumerate((0x1234567, 0x89ABCDE)):
                digest[i, full] = np.add.reduceat(mix(value ^ U64(seed)), starts)
            buffer = np.empty_like(value)
            for i in range(how.registers):
                np.multiply(value, factors[i], out=buffer)
                buffer += shift[i]
                registers[:, i] = register_scale(np.minimum.reduceat(buffer, starts))
        raw = [None] * n
        for i, r in zip(full.tolist(), registers):
            raw[i] = r.tobytes()
        return {"doc_id": rows.column(0), "n": size.astype(np.int64), "h1": signed(digest[0]),
                "h2": signed(digest[1]), "registers": pa.array(raw, pa.binary())}

    return mapped(docs.select("doc_id", "text"), "text", "doc_id long, n long, h1 long, h2 long, registers binary", work)


def stacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), -1)


def band_keys(sketches: DataFrame, how: NearDup, shared=None) -> DataFrame:
    """(key, id, n) of every band, of those in the bitmap ``shared`` if given."""
    def run(batches):
        for x in batches:
            if not x.num_rows:
                continue
            bands = stacked(x.column("registers")).reshape(x.num_rows, how.bands, how.band_rows).astype(U64)
            key = np.repeat(np.arange(1, how.bands + 1, dtype=U64)[None], x.num_rows, 0)
            for i in range(how.band_rows):
                key = mix(key * U64(0x9E3779B97F4A7C15) + bands[:, :, i])
            key = key.ravel()
            row = np.repeat(np.arange(x.num_rows), how.bands)
            if shared is not None:
                keep = in_bitmap(shared.value, key)
                key, row = key[keep], row[keep]
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(signed(key)), x.column("doc_id").take(row), x.column("n").take(row)],
                                             names=["key", "id", "n"])

    return in_arrow(sketches.select("doc_id", "n", "registers"), run, "key long, id long, n long")


def log_likelihood(more: np.ndarray, less: np.ndarray, same: np.ndarray, u: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Joint log-likelihood of the similarity j, from the numbers of greater, lesser and equal
    registers; u is the first set's share of both sizes."""
    v = 1 - u

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE_B - 1) / BASE_B) / np.log(BASE_B)

    a, b = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    return (more * np.log(np.maximum(a, tiny)) + less * np.log(np.maximum(b, tiny))
            + same * np.log(np.maximum(1 - a - b, tiny)))


def likely(pairs: DataFrame, how: NearDup) -> DataFrame:
    """Pairs (a, b) that their registers don't rule out."""
    least = how.percent / 100

    def run(batches):
        grid = np.arange(0, 1.0001, 0.02)
        for x in batches:
            if not x.num_rows:
                continue
            ra, rb = stacked(x.column("ra")), stacked(x.column("rb"))
            na, nb = (x.column(c).to_numpy() for c in ("na", "nb"))
            more, less = (ra > rb).sum(1), (ra < rb).sum(1)
            same, u = ra.shape[1] - more - less, na / (na + nb)
            top = np.minimum(na, nb) / np.maximum(na, nb)  # no higher similarity is possible
            best = np.max([log_likelihood(more, less, same, u, np.minimum(j, top)) for j in grid], axis=0)
            at = np.max([log_likelihood(more, less, same, u, np.minimum(j, top))
                         for j in np.arange(least, 1.0001, 0.01)], axis=0)
            keep = (at > best - REJECT) & (100 * np.minimum(na, nb) >= how.percent * np.maximum(na, nb))
            yield pa.RecordBatch.from_arrays(
                [x.column("a").filter(pa.array(keep)), x.column("b").filter(pa.array(keep))], names=["a", "b"])

    return in_arrow(pairs.select("a", "b", "na", "nb", "ra", "rb"), run, "a long, b long")


def confirm(pairs: DataFrame, how: NearDup) -> DataFrame:
    """Links (a, b) among pairs (a, b, ta, tb), from the full sets of both texts."""
    k, percent = how.words, how.percent

    def run(batches):
        for batch in batches:
            size = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy().astype(np.int64) for c in ("ta", "tb"))
            ends = np.concatenate([[0], np.cumsum(size)])
            i = 0
            while i < batch.num_rows:  # pairs of about CHUNK bytes of text at a time
                n = max(1, int(np.searchsorted(ends, ends[i] + CHUNK, "right")) - 1 - i)
                x = batch.slice(i, n)
                i += n
                sides = []
                for c in ("ta", "tb"):
                    column = x.column(c).fill_null("").cast(pa.large_binary()).to_pylist()
                    at = np.cumsum([0, *map(len, column)])
                    sides.append(shingles(np.frombuffer(b"".join(column), dtype=np.uint8), at, k))
                row = np.concatenate([s[0] for s in sides])
                value = np.concatenate([s[1] for s in sides])
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                twice = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
                inter = np.bincount(row[1:][twice], minlength=n)
                union = np.bincount(row, minlength=n) - inter
                keep = pa.array((union > 0) & (100 * inter >= percent * union))
                yield pa.RecordBatch.from_arrays([x.column("a").filter(keep), x.column("b").filter(keep)],
                                                 names=["a", "b"])

    return in_arrow(pairs.select("a", "b", "ta", "tb"), run, "a long, b long")


def shingle_rows(members: DataFrame, texts: DataFrame, how: NearDup) -> DataFrame:
    """A row per shingle of the members (id, component): id, component, n (size of the set), token."""
    k = how.words

    def run(batches):
        for batch in batches:
            for first, end, data, at in chunks(batch.column(2)):
                row, value = shingles(data, at, k)
                count = np.bincount(row, minlength=end - first)
                where = pa.array(first + row)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(where), batch.column(1).take(where),
                                                  pa.array(count[row]), pa.array(signed(value))], names=["id", "component", "n", "token"])

    held = only(texts, "id", bitmap(members, "id")).join(members, "id").select("id", "component", "text")
    return in_arrow(held, run, "id long, component long, n long, token long")


def prefix_pairs(members: DataFrame, texts: DataFrame, how: NearDup) -> DataFrame:
    """Pairs (a, b) of members (id, component) of different components that may be alike enough: all that are, and few others."""
    p = how.percent
    rows = written(shingle_rows(members, texts, how), "shingles")
    shared = written(rows.groupBy("token").agg(
        F.count("*").alias("df"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").drop("high"), "tokens")
    # The order: shingles of one component only, then by number of holders. Its end is enough to number the rest.
    mine = Window.partitionBy("id")
    placed = only(rows, "token", bitmap(shared, "token")).join(shared, "token").withColumns(
        {"place": F.row_number().over(mine.orderBy("df", "token")) - 1, "held": F.count("*").over(mine)}).withColumn(
        "place", F.expr("n - held + place"))
    # As the larger set of a pair, the shingles that the overlap with the smallest fitting set must reach; as the smaller one, fewer.
    first = placed.where(f"place <= n - ceil({p} * n / 100)").withColumns({
        "main": F.expr("component = low"), "short": F.expr(f"place <= n - ceil(2 * {p} * n / (100 + {p}))")})
    first = written(first.select("token", "id", "component", "n", "place", "main", "short"), "prefixes")
    # Documents of the token's least component, mostly the many that are linked already, don't meet each other.
    x = first.where("short").withColumn("other", F.explode(F.expr("IF(main, array(false), array(false, true))"))).alias("x")
    return x.join(first.alias("y"), F.expr(f"""x.token = y.token AND x.other = y.main AND x.component <> y.component AND x.n <= y.n
        AND 100 * x.n >= {p} * y.n AND (100 + {p}) * least(x.n - x.place, y.n - y.place) >= {p} * (x.n + y.n)""")).select(
        F.expr("greatest(x.id, y.id)").alias("a"), F.expr("least(x.id, y.id)").alias("b"))


def leader_pairs(open_: DataFrame, tested: DataFrame | None, how: NearDup) -> DataFrame:
    """One untested pair (a, b) a document at most: itself and the leader that it shares the most open band values with."""
    fits = f"100 * least(n, leader.n) >= {how.percent} * greatest(n, leader.n)"
    met = open_.where(f"component <> leader.component AND {fits}").groupBy("id", F.col("leader.id").alias("leader")).agg(
        F.count("*").alias("times"))
    pair = [F.greatest("id", "leader").alias("a"), F.least("id", "leader").alias("b")]
    if tested is not None:
        met = met.select("id", "leader", "times", *pair).join(tested, ["a", "b"], "left_anti")
    return met.groupBy("id").agg(F.max_by("leader", F.struct("times", -F.col("leader"))).alias("leader")).select(*pair).distinct()


def links_of(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, how: NearDup) -> DataFrame:
    """The confirmed links among candidate pairs (a, b)."""
    one = sketches.select("doc_id", "n", "registers")
    near = written(likely(
        pairs.join(one.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra")), "a")
        .join(one.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb")), "b"), how), "near")
    ta = only(texts, "id", bitmap(near, "a")).select(F.col("id").alias("a"), F.col("text").alias("ta"))
    tb = only(texts, "id", bitmap(near, "b")).select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return written(confirm(near.join(tb, "b").join(ta, "a"), how), "links")


def near_duplicates(docs: DataFrame, how: NearDup = NearDup()) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable) for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = written(sketch(docs, how), "sketches")
    named = sketches.where("n > 0 AND doc_id IS NOT NULL")
    digest = ["n", "h1", "h2"]
    classes = written(named.groupBy(*digest).agg(F.min("doc_id").alias("rep")), "classes")
    # One row a class: its representative. The bitmap only thins what the join has to move.
    reps = only(named, "doc_id", bitmap(classes, "rep")).join(
        classes.select(F.col("rep").alias("doc_id"), *digest), ["doc_id", *digest]).select("doc_id", "n", "registers")
    shared = band_keys(reps, how).groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    bands = written(band_keys(reps, how, bitmap(written(shared, "shared"), "key")), "bands")
    members = bitmap(bands, "id")
    reps = written(only(reps, "doc_id", members), "reps")
    texts = written(only(docs, "doc_id", members).select(F.col("doc_id").alias("id"), "text"), "texts")

    links, parts, tested = None, None, None
    for turn in range(STAR_ROUNDS + 1):
        last = turn == STAR_ROUNDS
        if parts is None:
            now = bands.withColumn("component", F.col("id"))
        else:
            now = bands.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
        order = F.xxhash64("id", F.lit(turn)) if turn and not last else F.col("id")
        keys = now.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.min(F.struct(order.alias("r"), "id", "component", "n")).alias("leader")).where("low < high").drop("low", "high")
        open_ = written(now.join(keys, "key"), "open")
        if open_.isEmpty():
            break
        if not last:
            pairs = leader_pairs(open_, tested, how)
        else:
            pairs = prefix_pairs(written(open_.select("id", "component").distinct(), "members"), texts, how).distinct()
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        found = links_of(pairs, reps, texts, how)
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            parts = components(links)
        if last:
            break
        tested = pairs if tested is None else tested.union(pairs)

    home = classes
    if parts is not None:
        home = classes.join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    else:
        home = classes.withColumn("component", F.lit(None).cast("long"))
    home = home.select(*digest, F.coalesce("component", "rep").alias("component"))
    return sketches.select("doc_id", *digest).join(home, digest, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component")))
        .otherwise(F.col("doc_id")).alias("component_id"))


def keep_representatives(docs: DataFrame, how: NearDup = NearDup()) -> DataFrame:
    """The rows of ``docs`` that are their component's least doc_id, with all their columns."""
    gone = near_duplicates(docs, how).where("component_id <> doc_id").select("doc_id").distinct()
    kept = pack(docs, F.col("doc_id").cast("long").alias("doc_id")).join(gone, "doc_id", "left_anti")
    return kept.select(*[F.col("row_").getField(c).alias(c) for c in docs.columns])
