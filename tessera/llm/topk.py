"""Exact top-k by inner product with M-trees.

Routing vectors from a bounded sample part the space in cells: every vector goes to the nearest one,
and a cell's covering radius is the distance of its farthest vector.  Cells are cut into trees of
bounded bytes, each built in one task as an M-tree (Ciaccia, Patella, Zezula, 1997) under Euclidean
distance: pages of at most PAGE entries, each entry with its covering radius and its distance to the
page's routing vector.  For a query q and a vector within r of c, the inner product is at most
q.c + |q| r; with the stored distance of c to its parent p also q.c <= q.p + |q| d(p, c), so whole
entries are passed over without computing q.c.  Each query starts from the k-th score that the
sample gives it, a bound that holds for the whole table, is sent only to the trees of cells whose
bound reaches it, and visits each best-first.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize
from .streams import emit, grouped
from .workers import lean, vacate

PAGE = 64
#: bytes of the vectors of a tree, and of the sample; queries that visit a tree in one task
TREE_BYTES = 16 << 20
SAMPLE_BYTES = 32 << 20
QUERY_SHARE = 1 << 16
QUERY_BLOCK = 256
PILOT = 1024
CELLS = 256
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def _dots(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows (held as doubles) with q: as int64, or as Python
    integers where they might not fit."""
    if len(x) and float(np.abs(x).max()) * float(np.abs(q).max(initial=0)) * x.shape[1] >= _EXACT:
        own = [int(v) for v in q.tolist()]
        out = np.empty(len(x), dtype=object)
        out[:] = [sum(int(a) * b for a, b in zip(row, own)) for row in x.tolist()]
        return out
    return (x @ q).astype(np.int64)


def _below(score: int) -> float:
    """A double that is not above the score."""
    near = float(score)
    return near if abs(near) < _EXACT else float(np.nextafter(near, -np.inf))


def _far(score: int) -> str | None:
    """What orders scores beyond a long among themselves, as text; null for others."""
    if -_LONG - 1 <= score <= _LONG:
        return None
    digits = str(abs(score))
    text = f"{len(digits):08d}{digits}"
    return text if score > 0 else text.translate(str.maketrans("0123456789", "9876543210"))


class MTree:
    """Nodes in arrays: a node is a page of entries, and an entry is a child node or a row."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.pages: list[tuple] = []
        self.root = self._build(np.arange(len(ids)), x.mean(axis=0) if len(ids) else np.zeros(x.shape[1])) if len(ids) else -1

    def _build(self, rows: np.ndarray, centre: np.ndarray) -> int:
        """A node over rows, routed by centre; its number."""
        far = np.sqrt(((self.x[rows] - centre) ** 2).sum(axis=1))
        if len(rows) <= PAGE:
            order = np.argsort(far, kind="stable")
            self.pages.append((True, rows[order], far[order], None, None))
            return len(self.pages) - 1
        fan = min(16, -(-len(rows) // PAGE) + 1)
        picks = [int(far.argmax())]  # farthest-point routing vectors
        gap = np.full(len(rows), np.inf)
        owner = np.zeros(len(rows), dtype=np.int64)
        while True:
            d = ((self.x[rows] - self.x[rows[picks[-1]]]) ** 2).sum(axis=1)
            nearer = d < gap
            owner[nearer], gap[nearer] = len(picks) - 1, d[nearer]
            if len(picks) == fan or gap.max() == 0:
                break
            picks.append(int(gap.argmax()))
        if len(picks) == 1:  # all alike: cut by position
            owner = np.arange(len(rows)) // PAGE
        children, centres, radii, to_parent = [], [], [], []
        for k in np.unique(owner):
            own = rows[owner == k]
            c = self.x[own].mean(axis=0)
            if len(own) == len(rows):
                half = len(own) // 2
                parts = [own[:half], own[half:]]
            else:
                parts = [own]
            for part in parts:
                c = self.x[part].mean(axis=0)
                children.append(self._build(part, c))
                centres.append(c)
                radii.append(float(np.sqrt(((self.x[part] - c) ** 2).sum(axis=1).max())))
                to_parent.append(float(np.sqrt(((c - centre) ** 2).sum())))
        self.pages.append((False, np.array(children), np.array(to_parent), np.array(centres), np.array(radii)))
        return len(self.pages) - 1

    def search(self, q: np.ndarray, own_id: int, k: int, floor: int | None) -> tuple[list[tuple[int, int]], int]:
        """The k best (score, id) of at least `floor` (ties to the smaller id), and how many inner products were computed."""
        if self.root < 0:
            return [], 0
        length = float(np.sqrt((q * q).sum()))
        slack = 1e-9 * (length * float(np.abs(self.x).max()) * np.sqrt(len(q)) + 1) + 0.5
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        least = -np.inf if floor is None else _below(floor)
        done = 0
        tie = 0
        queue: list[tuple] = [(-np.inf, tie, self.root, None)]
        while queue:
            bound, _, node, to_centre = heapq.heappop(queue)
            if -bound + slack < least:
                break
            leaf, items, far, centres, radii = self.pages[node]
            if leaf:
                if to_centre is not None:  # stored distances to the page's centre; rows are sorted by it
                    items = items[to_centre + length * far + slack >= least]
                if not len(items):
                    continue
                scores = _dots(self.x[items], q)
                done += len(items)
                keep = scores >= least
                for s, i in zip(scores[keep].tolist(), self.ids[items[keep]].tolist()):
                    if i == own_id:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                if len(best) == k:
                    least = max(least, _below(best[0][0]))
                continue
            open_ = np.arange(len(items))
            if to_centre is not None:
                open_ = open_[to_centre + length * (far + radii) + slack >= least]
            at = centres[open_] @ q
            done += len(open_)
            upper = at + length * radii[open_]
            for e, a, u in zip(open_.tolist(), at.tolist(), upper.tolist()):
                if u + slack >= least:
                    tie += 1
                    heapq.heappush(queue, (-u, tie, int(items[e]), a))
        return sorted(((s, -i) for s, i in best), key=lambda p: (-p[0], p[1])), done


def top_k(vectors: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", *, scale: int = 1024, tree_rows: int | None = None, query_block: int = QUERY_BLOCK, pilot: int = PILOT, cells: int = CELLS) -> DataFrame:
    """For each query row (is_query: a condition over vectors), the k rows of the largest inner
    product of floor(scale * x), its own id aside; ties go to the smaller id.

    Returns query_id, rank (from 1), vec_id, score.  Vectors that are null, empty or hold a null
    or non-finite component take no part, nor do rows of null id; vectors of another length than
    the query's score nothing with it; of rows that repeat an id and a score each counts as a
    candidate, and as a query once; fewer candidates give fewer rows; an empty table gives an empty
    result.  Scores beyond a long are ranked by what they are and shown as its ends.
    """
    spark = vectors.sparkSession
    x = F.col(embedding).cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), x.alias("raw"), is_query.alias("query")).where(F.col("id").isNotNull() & F.coalesce(sound, F.lit(False)) & (F.size("raw") > 0))
    rows = rows.select("id", F.transform("raw", lambda v: _floored(v, scale)).alias("x"), F.coalesce("query", F.lit(False)).alias("query"))
    n, asked, width = rows.agg(F.count("*"), F.count_if("query"), F.coalesce(F.max(F.size("x")), F.lit(1))).first()
    most = tree_rows or max(PAGE, TREE_BYTES // (8 * width))
    spread = max(1, min(n // 1024, 2 * spark.sparkContext.defaultParallelism))  # trees that keep all cores busy
    most = min(most, -(-n // spread)) if n and not tree_rows else most
    sample = [(r["id"], r["x"]) for r in rows.orderBy(F.xxhash64("id"), "id").limit(max(1, min(pilot, SAMPLE_BYTES // (8 * width)))).select("id", "x").collect()]
    router = Router(sample, min(cells, max(1, n // most)), k)
    shared = spark.sparkContext.broadcast(router)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        for batch in lean(batches):
            cell, far = shared.value.nearest(batch.column(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(far, pa.float64())], names=["id", "x", "query", "cell", "far"])

    placed = materialize(rows.mapInArrow(assign, "id bigint, x array<double>, query boolean, cell int, far double"), "vectors")
    facts = {r["cell"]: (r["n"], r["far"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    parts = {c: -(-m // most) for c, (m, _) in facts.items()}
    reach = spark.sparkContext.broadcast({c: (parts[c], far) for c, (_, far) in facts.items()})
    shares = max(1, -(-asked // QUERY_SHARE))
    blocks = max(1, -(-asked // (shares * query_block)))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        for batch in lean(batches):
            own, at, cut, floors = shared.value.visits(batch.column(0), batch.column(1), reach.value)
            whole = batch.take(pa.array(own))
            yield pa.RecordBatch.from_arrays([whole.column(0), whole.column(1), pa.array(at, pa.int32()), pa.array(cut, pa.int32()), pa.array(floors, pa.string())], names=["id", "x", "cell", "part", "floor"])

    share, block = (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(count)).cast("int") for salt, count in (("share", shares), ("query", blocks)))
    queries = placed.where("query").select("id", "x").dropDuplicates(["id", "x"]).mapInArrow(visit, "id bigint, x array<double>, cell int, part int, floor string")
    queries = queries.select("cell", "part", share.alias("share"), F.lit(1).alias("side"), block.alias("block"), "id", "x", "floor")
    known = F.create_map(*[F.lit(v) for c, p in parts.items() for v in (c, p)]) if parts else F.create_map(F.lit(0), F.lit(1))
    stored = placed.select("cell", F.pmod(F.xxhash64("id", F.lit("part")), F.element_at(known, F.col("cell"))).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), F.lit(0).alias("side"), F.lit(-1).alias("block"), "id", "x", F.lit(None).cast("string").alias("floor"))
    tasks = min(4096, max(1, sum(parts.values()) * shares))
    keys = ["cell", "part", "share", "side", "block"]
    dealt = stored.union(queries).repartition(tasks, "cell", "part", "share").sortWithinPartitions(*keys, "id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        yield from emit(_answers(batches, keys, k), pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("far", pa.string())]))

    found = dealt.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint, far string")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("far"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _floored(v, scale: int):
    y = v * F.lit(float(scale))
    return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole


def _by_width(lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, positions, rows) of a column of vectors, for each width."""
    lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for d in np.unique(lengths).tolist():
        mine = np.flatnonzero(lengths == d)
        yield d, mine, flat[starts[mine][:, None] + np.arange(d)]


class Router:
    """Cells of the space and first bounds, from a sample of (id, vector).  A width that the sample
    lacks is one cell around the origin, numbered by the width, below zero."""

    def __init__(self, sample: list, cells: int, k: int):
        self.k = k
        self.pilots: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.centres: dict[int, tuple[int, np.ndarray]] = {}  # width: first cell, vectors
        first = 0
        for d in sorted({len(v) for _, v in sample}):
            own = [(i, v) for i, v in sample if len(v) == d]
            x = np.array([v for _, v in own], dtype=np.float64)
            self.pilots[d] = np.array([i for i, _ in own]), x
            self.centres[d] = first, np.unique(x[: max(1, cells)], axis=0)
            first += len(self.centres[d][1])

    def _cells(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        if d not in self.centres:
            return np.array([-d]), np.zeros((1, d))
        first, c = self.centres[d]
        return first + np.arange(len(c)), c

    def nearest(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector and its distance to the cell's vector."""
        cell, far = np.zeros(len(lists), dtype=np.int32), np.zeros(len(lists))
        for d, mine, x in _by_width(lists):
            names, c = self._cells(d)
            for lo in range(0, len(mine), 2048):
                part = x[lo : lo + 2048]
                best = ((c * c).sum(axis=1)[None, :] - 2 * part @ c.T).argmin(axis=1)
                cell[mine[lo : lo + 2048]] = names[best]
                far[mine[lo : lo + 2048]] = np.sqrt(((part - c[best]) ** 2).sum(axis=1))
        return cell, far

    def visits(self, ids: pa.Array, lists: pa.Array, reach: dict[int, tuple[int, float]]):
        """(row, cell, part, floor) of each tree that a query has to visit."""
        own, at, cut, floors = [], [], [], []
        keys = ids.to_numpy()
        for d, mine, x in _by_width(lists):
            names, c = self._cells(d)
            known = np.array([j for j, name in enumerate(names.tolist()) if name in reach], dtype=np.int64)
            radius = np.array([reach[int(names[j])][1] for j in known.tolist()])
            for row, q in zip(mine.tolist(), x):
                floor = self._floor(int(keys[row]), d, q)
                length = float(np.sqrt((q * q).sum()))
                upper = c[known] @ q + length * radius
                slack = 1e-9 * (np.abs(upper) + length * radius + 1) + 0.5
                open_ = known if floor is None else known[upper + slack >= _below(floor)]
                for name in names[open_].tolist():
                    for part in range(reach[name][0]):
                        own.append(row)
                        at.append(name)
                        cut.append(part)
                        floors.append(None if floor is None else str(floor))
        return np.array(own, dtype=np.int64), at, cut, floors

    def _floor(self, own: int, d: int, q: np.ndarray) -> int | None:
        """The k-th score among the sample's other vectors."""
        if d not in self.pilots:
            return None
        ids, x = self.pilots[d]
        scores = _dots(x, q)[ids != own]
        return int(sorted(scores.tolist())[-self.k]) if len(scores) >= self.k else None


def _answers(batches: Iterator[pa.RecordBatch], keys: list[str], k: int):
    forest: dict[int, MTree] = {}
    at = None
    for table in grouped(batches, keys):
        here = tuple(table[c][0].as_py() for c in keys[:3])
        ids, lists = table["id"].to_numpy(), table["x"].combine_chunks()
        if here != at:
            at, forest = here, {}
        stored = table["side"][0].as_py() == 0
        floors = None if stored else table["floor"].to_pylist()
        for d, mine, x in _by_width(lists):
            if stored:
                forest[d] = MTree(ids[mine], x)
                continue
            if d not in forest:
                continue
            for row, q in zip(mine.tolist(), x):
                floor = floors[row]
                for s, v in forest[d].search(q, int(ids[row]), k, None if floor is None else int(floor))[0]:
                    yield int(ids[row]), v, max(-_LONG - 1, min(_LONG, s)), _far(s)
