"""Best-two-fit packing of token sequences.

Only lengths matter to packing, and there are no more of them than the capacity.  Pieces are
counted by length, the plan is made on those counts, and each piece then finds its place from its
rank among the pieces of its length.

The plan fills a bin greedily with the longest pieces that fit, then takes out the smallest piece
as long as two unpacked pieces fill the widened gap more tightly.  The same bin is repeated while
the counts allow, which gives exactly what packing bin after bin would: the choice only depends on
which lengths are still there.  A bin's pattern ends when one of its lengths runs short, and a
length can run short at most capacity / length times, so a plan has O(capacity log capacity)
patterns at any input size.
"""

from __future__ import annotations

import array
import bisect
import hashlib
import itertools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import LETTERS, stand_in
from .store import materialize
from .streams import text_slices
from .workers import Memo, lean, resident

CAPACITY = 2048
MEMO, PIECE_MEMO = 64 << 20, 32 << 20
MEMO_BYTES = 128


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Bins as (pieces of each length, number of such bins)."""
    left = {n: c for n, c in counts.items() if c > 0}
    if left and not (min(left) >= 1 and max(left) <= capacity):
        raise ValueError("lengths must lie between 1 and the capacity")
    lengths, out = sorted(left), []
    while lengths:
        own: dict[int, int] = {}
        gap = capacity
        at = len(lengths) - 1
        while gap and at >= 0:
            at = min(at, bisect.bisect_right(lengths, gap) - 1)
            if at < 0:
                break
            n = lengths[at]
            take = min((left[n] - own.get(n, 0)), gap // n)
            if take:
                own[n] = own.get(n, 0) + take
                gap -= take * n
            at -= 1
        while gap:
            small = min(own)
            pair = _two_for(lengths, left, own, small, gap + small)
            if pair is None:
                break
            own[small] -= 1
            if not own[small]:
                del own[small]
            for n in pair:
                own[n] = own.get(n, 0) + 1
            gap += small - sum(pair)
        times = min(left[n] // c for n, c in own.items())
        for n, c in own.items():
            left[n] -= c * times
            if not left[n]:
                lengths.remove(n)
        out.append((own, times))
    return out


def _two_for(lengths: list[int], left: dict[int, int], own: dict[int, int], small: int, gap: int) -> tuple[int, int] | None:
    """The two unpacked lengths, the smallest piece aside, of the largest sum within the gap, if
    it is above that piece's length."""
    free = np.array([n for n in lengths[: bisect.bisect_right(lengths, gap)] if left[n] > own.get(n, 0)], dtype=np.int64)
    if not len(free):
        return None
    spare = np.array([left[n] - own.get(n, 0) for n in free.tolist()])
    partner = np.searchsorted(free, gap - free, side="right") - 1
    own_only = (partner >= 0) & (free[np.maximum(partner, 0)] == free) & (spare < 2)
    partner = partner - own_only
    total = np.where(partner >= 0, free + free[np.maximum(partner, 0)], 0)
    k = int(total.argmax())
    if total[k] <= small:
        return None
    return int(free[k]), int(free[partner[k]])


def plan_places(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces, pieces a bin, first sequence, offset of the first),
    sorted by length and rank: what `place` looks up."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for own, times in plan_patterns(counts, capacity):
        offset = 0
        for n in sorted(own, reverse=True):
            c = own[n]
            rows.append((n, used.get(n, 0), c * times, c, sequence, offset))
            used[n] = used.get(n, 0) + c * times
            offset += n * c
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


def place(plan: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces of these lengths and ranks."""
    if not len(length):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.searchsorted(_joined(plan[:, 0], plan[:, 1]), _joined(length, rank), side="right") - 1
    row = plan[order]
    nth = rank - row[:, 1]
    return row[:, 4] + nth // row[:, 3], row[:, 5] + length * (nth % row[:, 3])


def _joined(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return (length.astype(np.int64) << 48) | rank.astype(np.int64)


_LOW = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(rf"[!-~{LETTERS}]+").fullmatch
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LOW}]+|[0-9]|[^{_LOW}0-9]+").findall
#: the normaliser and pre-tokeniser that the pieces above follow: fixed values
_KNOWN_LAYOUT = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class WordTokenizer:
    """Ids of whole texts by a tokenizer that drops white space, word by word with a memo.

    Texts are split at ASCII white space only, all of which the tokenizer drops; its normalisers
    work on characters and their neighbours within a word, so words are independent.  Words of
    ASCII and Latin-1 letters are cut by the file's pattern here and go straight to its merges,
    piece by piece with a memo; all others take the tokenizer's whole path.  A file with another
    normaliser, pattern or kind of added tokens is applied to whole texts.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo = Memo(MEMO)
        self.pieces = Memo(PIECE_MEMO)
        layout = json.loads(spec)
        added = layout.get("added_tokens") or []
        odd = any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") or len(t["content"].split()) != 1 for t in added)
        self.plain = all(layout.get(k) == v for k, v in _KNOWN_LAYOUT.items()) and not odd
        self.added = re.compile("|".join(sorted(re.escape(t["content"]) for t in added)) or r"(?!)").search
        leads = {t["content"][:1] for t in added}
        self.lead = leads.pop() if len(leads) == 1 else None  # how every added token begins

    def _plain_words(self, words: list[str]) -> list[bytes]:
        """Ids of words that the pieces' pattern covers."""
        known, tokenize, out = self.pieces.known, self.tokenizer.model.tokenize, []
        for word in words:
            parts = []
            for piece in _PIECES(word.lower()):
                ids = known.get(piece)
                if ids is None:
                    spelled = piece if piece.isascii() else stand_in(piece)  # printable ASCII stands for itself
                    ids = array.array("I", [t.id for t in tokenize(spelled)]).tobytes()
                    if len(piece) <= MEMO_BYTES:
                        self.pieces.put(piece, ids)
                parts.append(ids)
            out.append(parts[0] if len(parts) == 1 else b"".join(parts))
        self.pieces.bound()
        return out

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        """By the tokenizer's whole path, some at a time."""
        out = []
        for lo in range(0, len(texts), 4_000):
            out += [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch([t.decode() for t in texts[lo : lo + 4_000]], add_special_tokens=False)]
        return out

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if not self.plain:
            return self._whole(texts)
        words = [t.split() for t in texts]
        memo, known = self.memo, self.memo.known
        new = list(set(itertools.chain.from_iterable(words)).difference(known))
        long: dict[bytes, bytes] = {}
        plain, spelled, rest = [], [], []
        added, lead = self.added, self.lead
        for w, text in zip(new, b"\n".join(new).decode().split("\n")):
            if _PLAIN(text) and not ((lead is None or lead in text) and added(text)):
                plain.append(w)
                spelled.append(text)
            else:
                rest.append(w)
        for own, ids in ((plain, self._plain_words(spelled)), (rest, self._whole(rest))):
            if max(map(len, own), default=0) <= MEMO_BYTES:
                memo.put_all(own, ids)
                continue
            for w, x in zip(own, ids):
                if len(w) <= MEMO_BYTES:
                    memo.put(w, x)
                else:
                    long[w] = x
        if long:
            out = [b"".join([long[w] if w in long else known[w] for w in ws]) for ws in words]
        else:
            out = [b"".join(map(known.__getitem__, ws)) for ws in words]
        memo.bound()
        return out


def _tokenizer(key: str, spec) -> WordTokenizer:
    return resident(key, lambda: WordTokenizer(spec.value))


PIECES = "chunk int, local_rank bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: documents' ids followed by end_id, cut at the capacity.  chunk and
    local_rank number the pieces of each length within a task; ids (if asked) is the piece."""
    spec_text = open(path, encoding="utf-8").read()
    key, spec = hashlib.sha256(spec_text.encode()).hexdigest(), docs.sparkSession.sparkContext.broadcast(spec_text)
    schema = PIECES + (", ids array<int>" if with_ids else "")
    fields = [("chunk", pa.int32()), ("local_rank", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    arrow = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _tokenizer(key, spec)
        chunk = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        tail = np.array([end_id], dtype="<u4").tobytes()

        for batch in lean(batches):
            texts = pc.fill_null(batch.column(1), "")
            for lo, hi in text_slices(texts, 1 << 20):
                names = batch.column(0).slice(lo, hi - lo).to_pylist()
                rows, parts = [], []
                for name, own in zip(names, coder.ids(texts.slice(lo, hi - lo).cast(pa.binary()).to_pylist())):
                    own += tail
                    for piece, at in enumerate(range(0, len(own), 4 * capacity)):
                        part = own[at : at + 4 * capacity]
                        n = len(part) >> 2
                        rows.append((chunk, seen[n], name, piece, at >> 2, n, zlib.crc32(part)))
                        seen[n] += 1
                        if with_ids:
                            parts.append(part)
                columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum([r[5] for r in rows])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype="<i4"))))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def best_two_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (a written table with chunk, local_rank, length) with sequence_id and offset added.

    What reaches the driver is one count for each length; what is broadcast is the plan.
    """
    by_chunk = pieces.groupBy("chunk", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_chunk.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = pieces.sparkSession.sparkContext.broadcast(plan_places(counts, capacity))

    @F.arrow_udf("sequence_id bigint, offset bigint")
    def put(length: pa.Array, rank: pa.Array) -> pa.Array:
        where = place(shared.value, length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in where], names=["sequence_id", "offset"])

    ranked = pieces.join(bases, ["chunk", "length"]).withColumn("_place", put("length", F.col("base") + F.col("local_rank")))
    return ranked.select(*[c for c in pieces.columns if c not in ("chunk", "local_rank")], "_place.sequence_id", "_place.offset")


def pack(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pack whole documents into sequences of at most `capacity` tokens.

    Returns doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.  Null and empty
    texts are the end token alone; documents longer than the capacity, and no others, are cut into
    pieces of it; a null or repeated id is carried along, each row being its own document; an
    empty table gives an empty result; other columns are not read.
    """
    pieces = materialize(cut_pieces(docs, path, doc_id=doc_id, text=text, capacity=capacity, end_id=end_id, with_ids=with_ids), "pieces")
    return best_two_fit(pieces, capacity)
