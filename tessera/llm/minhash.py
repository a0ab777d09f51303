"""Near-duplicate texts by SetSketch registers over word shingles.

SetSketch (Ertl, "SetSketch: Filling the Gap between MinHash and HyperLogLog", 2021): register i of
a set is floor(1 - log_b(min h_i)), h_i(x) being exponentially distributed, truncated to 16 bits;
registers of a union are maxima, and with b near 1 two registers agree with probability close to
the Jaccard similarity J.

1. One pass sketches every document and reduces its shingle set to a 128-bit digest.  Documents of
   equal digest are one class, whose least id stands for it.
2. Bands of registers are bucket keys.  Rows per band are as long as their threshold allows: the
   longest with which a pair at the threshold is missed with probability MISS at most.
3. In each bucket all members are compared with the least one.  This links large groups of copies
   in time linear in their size; links are then merged by connected components.
4. Buckets that still hold several components are compared in pairs of blocks, members of different
   components only: first the joint maximum-likelihood estimate of J from the register
   comparison and the known set sizes (five standard errors below the threshold pass), then the
   full sets.  A block reports a link between two components once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import salt
from .components import connected_components
from .store import materialize, release
from .streams import emit, grouped, text_slices
from .workers import lean, vacate

REGISTERS = 256
BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 1
MISS = 1e-6
BLOCK = 256
#: bytes of full sets that a block may hold, a single set aside
BLOCK_BYTES = 8 << 20
SHINGLES_AT_ONCE = 1024
MEMO_ENTRIES = 300_000
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def band_rows(threshold: float, registers: int = REGISTERS, miss: float = MISS) -> int:
    """The largest number of rows per band with which a pair at the threshold is missed with
    probability `miss` at most."""
    rows = 1
    while rows < registers and (1 - threshold ** (rows + 1)) ** (registers // (rows + 1)) <= miss:
        rows += 1
    return rows


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        self[word] = h
        return h


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word n-grams: A-Z lower-cased, words parted by
    ASCII white space; a text of fewer words is one shingle, one without words none."""

    def __init__(self, n: int):
        self.n, self.words = n, _Words()

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.words) > MEMO_ENTRIES:
            self.words.clear()
        h = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(self.n, len(h))
        out = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            out = _mixed(out * _STEP + h[k : k + len(out)])
        return np.unique(out)


_factors = {}


def _multipliers(m: int) -> np.ndarray:
    if m not in _factors:
        _factors[m] = (np.random.default_rng(20_21).integers(0, 1 << 31, size=m, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
    return _factors[m]


def least(shingles: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """The minimum of each of m hash functions over a set; minima of unions are minima."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    a = _multipliers(m)
    low = np.full(m, 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, len(x), SHINGLES_AT_ONCE):
        np.minimum(low, (a * x[None, lo : lo + SHINGLES_AT_ONCE]).min(axis=1), out=low)
    return low


def registers(low: np.ndarray) -> np.ndarray:
    """Registers from minima of uniform hashes: the exponential minimum is a monotone function of
    the uniform one."""
    h = -np.log1p(-(low.astype(np.float64) + 0.5) / 4294967296.0) / RATE
    return np.clip(np.floor(1 - np.log(h) / math.log(BASE)), 0, TOP).astype(np.uint16)


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def joint_estimate(mine: np.ndarray, others: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    """Maximum-likelihood J of one set and others from register comparisons and set sizes, in the
    limit b -> 1: the root in [0, 1] of
    u v m J^2 - (D0 (u^2 + v^2) + D+ v^2 + D- u^2) J + D0 u v, u and v being the sizes' shares."""
    m = others.shape[1]
    same = (others == mine).sum(axis=1).astype(np.float64)
    above = (others < mine).sum(axis=1).astype(np.float64)
    below = m - same - above
    u, v = n / (n + sizes), sizes / (n + sizes)
    a, b, c = u * v * m, same * (u * u + v * v) + above * v * v + below * u * u, same * u * v
    return (b - np.sqrt(np.maximum(b * b - 4 * a * c, 0))) / (2 * a)


def band_keys(regs: np.ndarray, rows: int) -> np.ndarray:
    """Bucket keys (documents x bands) of register rows."""
    bands = regs.shape[1] // rows
    own = regs[:, : bands * rows].astype(np.uint64).reshape(len(regs), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, own.shape[:2]).copy()
    for k in range(rows):
        keys = _mixed(keys * _STEP + own[:, :, k] + np.uint64(1))
    return keys.view(np.int64)


def _as_binary(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def sketch(docs: DataFrame, doc_id: str, text: str, n: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, bands) of each document; h1 and h2 are the digest of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        shingle = Shingler(n)
        for batch in lean(batches):
            ids = batch.column(0)
            for lo, hi in text_slices(batch.column(1), 1 << 20, 512):
                texts = _as_binary(batch.column(1).slice(lo, hi - lo))
                sizes, digests, low = [], [], np.zeros((len(texts), REGISTERS), dtype=np.uint32)
                for i, t in enumerate(texts):
                    own = shingle(t)
                    sizes.append(len(own))
                    digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                    low[i] = least(own)
                pairs = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                keys = band_keys(registers(low), rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo),
                        pa.array(sizes, pa.int64()),
                        pa.array(pairs[:, 0]),
                        pa.array(pairs[:, 1]),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel())),
                    ],
                    names=["doc_id", "n_shingles", "h1", "h2", "bands"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, n_shingles bigint, h1 bigint, h2 bigint, bands array<bigint>")


def _full_sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, digests: DataFrame, n: int) -> DataFrame:
    """(member, set, regs) of the wanted documents: their full shingle sets and registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        shingle = Shingler(n)
        for batch in lean(batches):
            for lo, hi in text_slices(batch.column(1), 1 << 20, 512):
                sets = [shingle(t) for t in _as_binary(batch.column(1).slice(lo, hi - lo))]
                regs = registers(np.stack([least(s) for s in sets]))
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([r.tobytes() for r in regs], pa.binary())],
                    names=["member", "h1", "h2", "set", "regs"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    texts = docs.select(F.col(doc_id).alias("member"), F.col(text).alias("text")).join(wanted, "member", "left_semi")
    sets = texts.mapInArrow(run, f"member {kind}, h1 bigint, h2 bigint, set binary, regs binary")
    return sets.join(digests, ["member", "h1", "h2"], "left_semi").dropDuplicates(["member"]).select("member", "set", "regs")


def _links(groups: DataFrame, keys: list[str], kind: str, numerator: int, denominator: int) -> DataFrame:
    """groups: rows (keys, side, member, comp, set, regs), sorted by keys within partitions.
    Links (u, v) that join different components, found on full sets between members of side 0
    (and, where inner = 1, among them) and of side 1."""
    floor = numerator / denominator
    floor -= 5 * math.sqrt(floor * (1 - floor) / REGISTERS)
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def compare(table: pa.Table):
        side = table["side"].to_numpy()
        inner = table["inner"][0].as_py()
        member, comp = table["member"].to_numpy(), table["comp"].to_numpy().copy()
        regs = np.stack([np.frombuffer(r, dtype=np.uint16) for r in table["regs"].to_pylist()])
        sets = [np.frombuffer(s, dtype=np.uint64) for s in table["set"].to_pylist()]
        sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        for k, i in enumerate(left.tolist()):
            with_ = left[k + 1 :] if inner else right
            with_ = with_[comp[with_] != comp[i]]
            low, high = np.minimum(sizes[with_], sizes[i]), np.maximum(sizes[with_], sizes[i])
            with_ = with_[denominator * low >= numerator * high]
            if len(with_):
                with_ = with_[joint_estimate(regs[i], regs[with_], int(sizes[i]), sizes[with_]) >= floor]
            if not len(with_):
                continue
            other = np.concatenate([sets[j] for j in with_.tolist()])
            own = sets[i]
            hit = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
            common = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(sizes[with_])[:-1]]))
            for j in with_[denominator * common >= numerator * (sizes[with_] + sizes[i] - common)].tolist():
                if comp[j] != comp[i]:
                    comp[comp == comp[j]] = comp[i]
                    yield int(member[i]), int(member[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit((pair for table in grouped(batches, keys) if table.num_rows > 1 for pair in compare(table)), schema)

    return groups.mapInArrow(run, f"u {kind}, v {kind}")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, shingle: int = 5, numerator: int = 80, denominator: int = 100, block: int = BLOCK) -> DataFrame:
    """Classes of near-duplicate texts: documents are linked where
    denominator * |intersection| >= numerator * |union| of their shingle sets.

    Returns doc_id, n_shingles, component_id (least id reachable by links, itself included), kept
    (doc_id = component_id), a row for each row of docs.  Texts that are null or without words have
    n_shingles 0 and link with nothing; rows of null id link with nothing and are kept, with a null
    component_id; repeated rows share a component; where an id is repeated with other text, its
    rows are one node whose links are those of the text of the least digest; an empty table gives
    an empty result; other columns are not read.  Ids are of an integer type.
    """
    rows = band_rows(numerator / denominator)
    docs = docs.withColumn(doc_id, F.col(doc_id).cast("bigint"))
    kind = "bigint"
    signed = materialize(sketch(docs, doc_id, text, shingle, rows), "sketches")
    full = signed.where("doc_id is not null and n_shingles > 0")
    classes = materialize(full.groupBy("h1", "h2").agg(F.min("doc_id").alias("member")), "classes")

    lead = classes.groupBy("member").agg(F.min(F.struct("h1", "h2")).alias("d")).select("member", "d.h1", "d.h2")
    bands = full.join(lead, [full.doc_id == lead.member, full.h1 == lead.h1, full.h2 == lead.h2]).select("member", "bands", F.col("n_shingles").alias("weight")).dropDuplicates(["member"])
    entries = bands.select("member", "weight", F.explode("bands").alias("band"))
    blocks = lambda n, shingles: F.greatest(F.ceil(n / block), F.ceil(shingles * 8 / BLOCK_BYTES)).cast("int")
    sizes = entries.groupBy("band").agg(F.min("member").alias("pivot"), F.count("*").alias("size")).where("size > 1")
    shared = materialize(entries.join(sizes, "band"), "bands")

    wanted = shared.select("member").distinct()
    sets = materialize(_full_sets(docs, doc_id, text, wanted, lead, shingle), "sets")

    # every member with the least one of its buckets
    star = shared.where("member <> pivot").select("member", "pivot", "weight").distinct()
    widths = star.groupBy("pivot").agg(blocks(F.count("*"), F.sum("weight")).alias("blocks"))
    dealt = star.join(widths, "pivot").select(F.col("pivot").alias("k1"), salt("member", F.col("blocks")).alias("k2"), F.lit(1).alias("side"), "member")
    centres = widths.select(F.col("pivot").alias("k1"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("k2"), F.lit(0).alias("side"), F.col("pivot").alias("member"))
    groups = dealt.union(centres).withColumn("comp", F.col("member")).withColumn("inner", F.lit(0))
    edges = _links(_dealt(groups, sets, ["k1", "k2"]), ["k1", "k2"], kind, numerator, denominator)
    first = materialize(connected_components(edges), "first")

    # what is left: members of different components in one bucket, other than with its least one
    placed = shared.join(first.withColumnRenamed("node", "member"), "member", "left").select("band", "member", "pivot", "weight", F.coalesce("component", "member").alias("comp"))
    mixed = (
        placed.groupBy("band")
        .agg(F.min_by("comp", "member").alias("main"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"))
        .where("lo <> hi and n > 2")
        .select("band", "main")
    )
    open_ = materialize(placed.join(mixed, "band").where("member <> pivot").withColumn("odd", F.col("comp") != F.col("main")), "open")
    of = lambda test: blocks(F.count_if(test), F.sum(F.when(test, F.col("weight")).otherwise(0)))
    counts = open_.groupBy("band").agg(of(F.col("odd")).alias("odd_blocks"), of(~F.col("odd")).alias("main_blocks"))
    # group (band, i, j): odd block i with odd block j >= i, or with main block j - odd_blocks
    split = open_.join(counts.where("odd_blocks > 0"), "band")
    odd = split.where("odd").withColumn("own", salt("member", F.col("odd_blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("odd_blocks") + F.col("main_blocks") - 1)))
    odd = odd.select("band", F.least("own", "other").alias("k2"), F.greatest("own", "other").alias("k3"), ((F.col("own") > F.col("other"))).cast("int").alias("side"), "member", "comp", (F.col("own") == F.col("other")).cast("int").alias("inner"))
    main = split.where("not odd").withColumn("own", salt("member", F.col("main_blocks")) + F.col("odd_blocks")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("odd_blocks") - 1)))
    main = main.select("band", F.col("other").alias("k2"), F.col("own").alias("k3"), F.lit(1).alias("side"), "member", "comp", F.lit(0).alias("inner"))
    groups = odd.union(main).withColumnRenamed("band", "k1")
    keys = ["k1", "k2", "k3"]
    more = _links(_dealt(groups, sets, keys), keys, kind, numerator, denominator)
    label = lambda side: first.select(F.col("node").alias(side), F.col("component").alias(f"{side}c"))
    merged = more.join(label("u"), "u", "left").join(label("v"), "v", "left").select(F.coalesce("uc", "u").alias("u"), F.coalesce("vc", "v").alias("v"))
    second = connected_components(merged).select(F.col("node").alias("comp"), F.col("component").alias("root"))

    members = classes.join(first.withColumnRenamed("node", "member"), "member", "left").select("h1", "h2", F.coalesce("component", "member").alias("comp"))
    members = materialize(members.join(second, "comp", "left").select("h1", "h2", F.coalesce("root", "comp").alias("class_id")), "members")
    out = signed.select("doc_id", "n_shingles", "h1", "h2").join(members, ["h1", "h2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("class_id"))).otherwise(F.col("doc_id"))
    result = out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    release(shared, sets, open_, classes)
    return result


def _dealt(groups: DataFrame, sets: DataFrame, keys: list[str]) -> DataFrame:
    joined = groups.join(sets, "member").select(*keys, "side", "inner", "member", "comp", "set", "regs")
    return joined.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
