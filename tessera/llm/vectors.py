"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated pseudo-randomly (three rounds of random signs and the fast Hadamard transform)
and hashed to the nearest of the 2d signed axes (Andoni et al., "Practical and Optimal LSH for
Angular Distance", 2015).  A table joins K such hashes into a bucket; each vector is entered in
its P most likely buckets of every table (multiprobe on both sides), which multiplies the chance
that two near vectors meet.  K follows the number of vectors, so that a bucket holds a few
unrelated vectors at any size, and the number of tables follows from the chance, measured on
simulated pairs at the threshold, that a table finds a pair.

Equal vectors are one class with a weight.  Buckets are compared in pairs of blocks.  A pair found in
several buckets counts once: if it shares hot buckets (of more than HOT members), in the least of
those, which the members' short lists of hot buckets tell; else in the first of EARLY tables where
both have the same likeliest bucket; else as a row that is made distinct afterwards.  So the links of
a large group are counted without a row for each, and members carry no more than their vector and a
few codes.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import block_pairs
from .components import connected_components
from .store import materialize, release
from .streams import grouped, whole_groups
from .workers import lean, vacate

PROBES = 4
OCCUPANCY = 8
MISS = 1e-5
BLOCK = 512
HOT = 64
EARLY = 8
#: tables that are worth their entries; beyond, fewer hashes need fewer tables
MOST_TABLES = 196
#: where the tables of the trial begin, apart from those in use
_TRIAL = 1 << 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows whose length is a power of two, orthonormal."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


@functools.lru_cache(maxsize=1024)
def _signs(size: int, table: int, hashes: int) -> np.ndarray:
    """Signs of a table's rotations, drawn when the table is asked for."""
    return np.random.default_rng([7, size, hashes, table]).integers(0, 2, size=(hashes, 3, size), dtype=np.int8)


def bucket_codes(unit: np.ndarray, tables: int, hashes: int, probes: int, first: int = 0) -> np.ndarray:
    """int64 bucket codes (vectors x tables x probes) of unit vectors, likeliest probe first."""
    n, d = unit.shape
    size = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :d] = unit
    out = np.empty((n, tables, probes), dtype=np.int64)
    width = min(probes, 2 * size)
    for t in range(tables):
        codes, costs = np.full((n, 1), d, dtype=np.int64), np.zeros((n, 1))
        for k in range(hashes):
            y = padded
            for s in _signs(size, first + t, hashes)[k]:
                y = hadamard(y * (s * 2.0 - 1.0))
            both = np.concatenate([y, -y], axis=1)
            top = np.argpartition(-both, width - 1, axis=1)[:, :width]
            value = np.take_along_axis(both, top, axis=1)
            order = np.lexsort((top, -value), axis=1)
            top, value = np.take_along_axis(top, order, axis=1), np.take_along_axis(value, order, axis=1)
            cost = (value[:, :1] - value) ** 2
            codes = (codes[:, :, None] * (2 * size + 1) + top[:, None, :] + 1).reshape(n, -1)
            costs = (costs[:, :, None] + cost[:, None, :]).reshape(n, -1)
            best = np.lexsort((codes, costs), axis=1)[:, :probes]
            codes, costs = np.take_along_axis(codes, best, axis=1), np.take_along_axis(costs, best, axis=1)
        if codes.shape[1] < probes:
            codes = np.concatenate([codes, np.repeat(codes[:, :1], probes - codes.shape[1], axis=1)], axis=1)
        out[:, t] = codes + np.int64((t + 1) * 0x1F3A5C7E9B2D4F61 % (1 << 62))
    return out


@functools.lru_cache(maxsize=16)
def table_count(d: int, cosine: float, hashes: int, probes: int, miss: float = MISS) -> int:
    """Tables after which a pair at the threshold is missed with probability `miss`, from 2,000
    simulated pairs in four tables."""
    rng = np.random.default_rng(11)
    a = rng.standard_normal((2000, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, d))
    b -= (a * b).sum(1, keepdims=True) * a
    norm = np.linalg.norm(b, axis=1, keepdims=True)
    b = cosine * a + math.sqrt(max(0.0, 1 - cosine * cosine)) * b / np.where(norm > 0, norm, 1)
    ca, cb = (bucket_codes(x, 4, hashes, probes, _TRIAL) for x in (a, b))
    found = float((ca[:, :, :, None] == cb[:, :, None, :]).any(axis=(2, 3)).mean())
    if found >= 1:
        return 1
    return max(1, math.ceil(math.log(miss) / math.log1p(-max(found, 1e-9))))


def plan(d: int, cosine: float, hashes: int, probes: int, miss: float = MISS) -> tuple[int, int]:
    """(hashes, tables): `hashes` or fewer, with which the tables that the miss rate asks for are
    not too many; without hashes all vectors share one bucket and no pair is missed."""
    for h in range(hashes, 0, -1):
        tables = table_count(d, cosine, h, probes, miss)
        if tables <= MOST_TABLES:
            return h, tables
    return 0, 1


def hash_count(vectors: int, d: int, probes: int = PROBES, occupancy: int = OCCUPANCY) -> int:
    """Hashes a bucket with which unrelated vectors leave `occupancy` entries in one on average."""
    axes = 2 << max(1, (d - 1).bit_length())
    return max(1, math.ceil(math.log(max(vectors, 1) * probes / occupancy) / math.log(axes)))


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", *, cosine: float = 0.9, probes: int = PROBES, block: int = BLOCK, miss: float = MISS) -> DataFrame:
    """Links of vectors with cosine (double precision) of `cosine` or more, and their components.

    Returns vec_id, n_links (other rows linked directly), component_id (least id reachable, itself
    included), kept (vec_id = component_id), a row for each row of vectors.  Vectors that are
    null, empty, zero or hold a null or non-finite component link with nothing, and vectors of
    different length do not link with each other; rows of null id do not take part and are kept with a null
    component_id; repeated rows count as rows; an empty table gives an empty result; other columns
    are not read.
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    sound = F.coalesce(F.col("vec_id").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & (F.aggregate("x", F.lit(0.0), lambda s, v: F.greatest(s, F.abs(v))) > 0), F.lit(False))
    rows = rows.select("vec_id", F.when(sound, F.col("x")).alias("x"))
    classes = materialize(rows.where("x is not null").groupBy("x").agg(F.min("vec_id").alias("member"), F.count("*").alias("weight")), "vectors")
    total = classes.count()

    def codes_of(x: np.ndarray) -> np.ndarray:
        d = x.shape[1]
        h, tables = plan(d, cosine, hash_count(total, d, probes), probes, miss)
        return bucket_codes(x, tables, h, probes)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        for batch in lean(batches):
            member = batch.column(0).to_numpy()
            lengths = pa.compute.list_value_length(batch.column(1)).to_numpy()
            flat = batch.column(1).flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(lengths)])
            for d in np.unique(lengths):
                mine = np.flatnonzero(lengths == d)
                for lo in range(0, len(mine), 1024):
                    at = mine[lo : lo + 1024]
                    x = flat[(starts[at][:, None] + np.arange(d))].astype(np.float64)
                    unit = _unit(x)
                    codes = codes_of(unit)
                    early = np.ascontiguousarray(codes[:, :EARLY, 0])
                    codes = codes.reshape(len(at), -1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(member[at]), pa.array(_payload(x), pa.binary()), pa.array([r.tobytes() for r in early], pa.binary()),
                         pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * codes.shape[1]), pa.array(codes.ravel()))],
                        names=["member", "unit", "early", "buckets"],
                    )

    hashed = materialize(classes.select("member", "x").mapInArrow(enter, "member bigint, unit binary, early binary, buckets array<bigint>"), "hashed")
    entries = hashed.select("member", F.explode(F.array_distinct("buckets")).alias("bucket"))
    hot = entries.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("bucket")
    lists = entries.join(hot, "bucket").groupBy("member").agg(F.collect_list("bucket").alias("hots"))
    data = hashed.select("member", "unit", "early").join(classes.select("member", "weight"), "member").join(lists, "member", "left")
    keys = ["bucket", "lo", "hi"]
    groups = block_pairs(entries, "bucket", "member", block, HOT).join(data, "member").select(*keys, "hot", "side", "member", "unit", "early", "hots", "weight")
    groups = groups.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        for table in whole_groups(lean(batches), keys):
            table = table.combine_chunks()
            small = pa.compute.and_(pa.compute.invert(table["hot"]), pa.compute.equal(table["lo"], table["hi"]))
            yield from _compare_small(table.filter(small), cosine)
            for group in grouped(table.filter(pa.compute.invert(small)).to_batches(), keys):
                if group.num_rows > 1:
                    yield from _compare(group, cosine)

    found = materialize(groups.mapInArrow(run, "u bigint, v bigint, n bigint"), "links")
    counted = found.where("n > 0 and u = v").select("u", "n").unionByName(found.where("n > 0 and u <> v").distinct().select("u", "n"))
    linked = counted.groupBy("u").agg(F.sum("n").alias("n")).withColumnRenamed("u", "member")
    joined = connected_components(found.where("u <> v").select("u", "v")).select(F.col("node").alias("member"), F.col("component").alias("root"))
    answer = classes.join(linked, "member", "left").join(joined, "member", "left").select(
        "x", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "member").alias("root")
    )
    out = rows.join(answer, "x", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _payload(x: np.ndarray) -> list[bytes]:
    """Rows as bytes, in single precision where that loses nothing."""
    small = x.astype(np.float32)
    same = (small.astype(np.float64) == x).all(axis=1)
    return [b"4" + s.tobytes() if ok else b"8" + r.tobytes() for s, r, ok in zip(small, x, same.tolist())]


def _vector(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, dtype=np.float32 if payload[:1] == b"4" else np.float64, offset=1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(payloads: list[bytes]) -> np.ndarray:
    """Payloads of one length as rows of doubles."""
    raw = np.frombuffer(b"".join(payloads), dtype=np.uint8).reshape(len(payloads), -1)
    kind = np.float32 if payloads[0][:1] == b"4" else np.float64
    return np.ascontiguousarray(raw[:, 1:]).view(kind).astype(np.float64)


def _pairs(sizes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within groups of consecutive rows, groups of one size at a time."""
    for m in np.unique(sizes[sizes > 1]).tolist():
        a, b = np.triu_indices(m, 1)
        own = starts[sizes == m]
        step = max(1, (1 << 15) // len(a))
        for lo in range(0, len(own), step):
            at = own[lo : lo + step, None]
            yield (at + a).ravel(), (at + b).ravel()


def _forest(rows: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row that each row reaches along links."""
    root = np.arange(rows)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = np.minimum(low, low[low])
        if (low == root).all():
            return root
        root = low


def _compare_small(table: pa.Table, cosine: float) -> Iterator[pa.RecordBatch]:
    """What `_compare` gives, for many groups of one block each that are not hot."""
    payloads = table["unit"].to_pylist()
    kinds = np.array([(len(p) - 1) // (4 if p[:1] == b"4" else 8) for p in payloads], dtype=np.int64)
    for d in np.unique(kinds).tolist():
        mine = np.flatnonzero(kinds == d)
        own = table if len(mine) == len(payloads) else table.take(pa.array(mine))
        bucket, block = own["bucket"].to_numpy(), own["lo"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])]))
        sizes = np.diff(np.concatenate([starts, [len(bucket)]]))
        if not (sizes > 1).any():
            continue
        x = np.empty((len(mine), d))
        here = [payloads[k] for k in mine.tolist()]
        narrow = np.array([p[:1] == b"4" for p in here])
        for kind in (True, False):
            rows = np.flatnonzero(narrow == kind)
            if len(rows):
                x[rows] = _matrix([here[k] for k in rows.tolist()])
        x = _unit(x)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for a, b in _pairs(sizes, starts):
            near = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
            found.append((a[near], b[near]))
        i, j = (np.concatenate(f) for f in zip(*found))
        if not len(i):
            continue
        member, weight = own["member"].to_numpy(), own["weight"].to_numpy()
        hots = [frozenset(h) if h else None for h in own["hots"].to_pylist()]
        listed = np.array([h is not None for h in hots])
        root = _forest(len(member), i, j)
        a, b = i, j
        both = np.flatnonzero(listed[a] & listed[b])
        if len(both):  # pairs that meet in a hot bucket are counted there
            open_ = np.ones(len(a), dtype=bool)
            open_[both] = [hots[p].isdisjoint(hots[q]) for p, q in zip(a[both].tolist(), b[both].tolist())]
            a, b = a[open_], b[open_]
        early = np.frombuffer(b"".join(own["early"].to_pylist()), dtype=np.int64).reshape(len(member), -1)
        same = early[a] == early[b]
        met = same.any(axis=1)
        counted = met & (early[a, same.argmax(axis=1)] == bucket[a])
        gained = np.zeros(len(member), dtype=np.int64)
        np.add.at(gained, a[counted], weight[b[counted]])
        np.add.at(gained, b[counted], weight[a[counted]])
        yield _rows(member, weight, gained, a[~met], b[~met], root)


def _rows(member: np.ndarray, weight: np.ndarray, gained: np.ndarray, p: np.ndarray, q: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    got, tied = np.flatnonzero(gained), np.flatnonzero(root != np.arange(len(root)))
    u = np.concatenate([member[got], member[p], member[q], member[tied]])
    v = np.concatenate([member[got], member[q], member[p], member[root[tied]]])
    n = np.concatenate([gained[got], weight[q], weight[p], np.zeros(len(tied), dtype=np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(n)], names=["u", "v", "n"])


def _compare(table: pa.Table, cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows (u, v, n) of a group: links that u gained in it (v = u), links of a pair that may be
    found elsewhere too (u linked with v, of weight n; both ways), and a spanning forest of all
    links found (n = 0)."""
    side = table["side"].to_numpy()
    bucket = table["bucket"][0].as_py()
    member, weight = table["member"].to_numpy(), table["weight"].to_numpy()
    units = [_vector(b) for b in table["unit"].to_pylist()]
    width = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
    if (width != width[0]).any():  # another dimension by a coincidence of codes
        for w in np.unique(width):
            part = table.filter(pa.array(width == w))
            if part.num_rows > 1:
                yield from _compare(part, cosine)
        return
    x = _unit(np.stack(units))
    whole = table["lo"][0].as_py() == table["hi"][0].as_py()
    left = np.flatnonzero(side == 0)
    right = left if whole else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return
    i, j = np.nonzero(x[left] @ x[right].T >= cosine - 1e-9)
    i, j = left[i], right[j]
    if whole:
        i, j = i[i < j], j[i < j]
    near = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
    i, j = i[near], j[near]
    if not len(i):
        return
    gained = np.zeros(len(units), dtype=np.int64)
    hot = table["hot"][0].as_py()
    lists = [h or () for h in table["hots"].to_pylist()]
    names = sorted({b for own in lists for b in own if not hot or b < bucket})
    shared = None
    if names:  # pairs with a hot bucket in common: in a hot group, one before this
        column = {b: k for k, b in enumerate(names)}
        holds = np.zeros((len(units), len(names)), dtype=np.float32)
        for row, own in enumerate(lists):
            holds[row, [column[b] for b in own if b in column]] = 1
        shared = holds @ holds.T > 0
    early = np.frombuffer(b"".join(table["early"].to_pylist()), dtype=np.int64).reshape(len(units), -1)
    loose: list[np.ndarray] = []
    for lo in range(0, len(i), 1 << 15):
        a, b = i[lo : lo + (1 << 15)], j[lo : lo + (1 << 15)]
        if shared is not None:
            open_ = ~shared[a, b]
            a, b = a[open_], b[open_]
        if not hot:
            same = early[a] == early[b]
            met = same.any(axis=1)
            loose += [np.stack([a[~met], b[~met]])]
            own = met & (early[a, same.argmax(axis=1)] == bucket)
            a, b = a[own], b[own]
        np.add.at(gained, a, weight[b])
        np.add.at(gained, b, weight[a])
    p, q = np.concatenate(loose, axis=1) if loose else np.zeros((2, 0), dtype=np.int64)
    yield _rows(member, weight, gained, p, q, _forest(len(units), i, j))
