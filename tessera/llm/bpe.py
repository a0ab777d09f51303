"""Byte-level BPE by forced-boundary splitting.

A byte pair that no vocabulary token holds can never end up inside one token, so a place where it
occurs is a certain cut: the fragments on both sides are encoded independently and their ids
concatenated.  Fragments repeat all over a corpus, so each worker keeps a bounded memo of them.

The tokenizers of this kind first split text by a pattern whose matches depend on what stands to
the right, and on a preceding run of white space only.  A forced cut is therefore taken only where
the character on its left is no white space and the one on its right is no apostrophe (which could
open a contraction anew); elsewhere the fragment stays longer, which changes nothing in the result.
"""

from __future__ import annotations

import array
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .streams import text_slices
from .workers import Memo, lean, resident

MEMO = 48 << 20
MEMO_BYTES = 256
FRAGMENTS_AT_ONCE = 400_000
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_SPACES = b" \t\n\r\x0b\x0c"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, all others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: ASCII and Latin-1 letters, whose class and lower case every Unicode version shares
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_ONE_PRETOKEN = re.compile(rf" ?[{LETTERS}]+| ?[0-9]+| ?[!-&(-/:-@\[-`{{-~]+").fullmatch
_STAND_INS = {b: c for c, b in byte_alphabet().items()}


def stand_in(piece: str) -> str:
    """The text as byte-level vocabularies spell it."""
    return piece.encode().decode("latin-1").translate(_STAND_INS)


class ForcedBoundaryBPE:
    """Encoder and decoder of one tokenizer file (its JSON text).

    ordinary: special tokens written out in a text are ordinary text, never their ids."""

    def __init__(self, spec: str, ordinary: bool = False):
        from tokenizers import Tokenizer

        layout = json.loads(spec)
        pre = layout.get("pre_tokenizer") or {}
        if layout.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("forced boundaries need a plain byte-level tokenizer without normaliser or prefix space")
        tokens = layout.get("added_tokens", [])
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in tokens):
            raise ValueError("forced boundaries need added tokens that do not depend on their surroundings")
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet = byte_alphabet()
        added = {t["content"] for t in tokens}
        self.tokenizer.encode_special_tokens = ordinary
        found = {t["content"] for t in tokens if not (ordinary and t.get("special"))}  # those that texts may hold
        self.added = re.compile("|".join(map(re.escape, sorted(found))) if found else r"(?!)").search
        leads = {t[:1] for t in found}
        self.lead = leads.pop() if len(leads) == 1 else None  # how every added token begins
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.table: list[bytes] = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            known = token not in added and all(c in alphabet for c in token)
            self.table[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        inside = np.zeros((256, 256), dtype=bool)
        for token in [*self.table, *(c.encode() for c in _CONTRACTIONS)]:
            b = np.frombuffer(token, dtype=np.uint8)
            inside[b[:-1], b[1:]] = True
        cut = ~inside
        cut[list(_SPACES), :] = False
        cut[:, ord("'")] = False
        cut[:, 0x80:0xC0] = False  # never inside a character
        self.cut = cut.ravel()
        self.memo = Memo(MEMO)

    def boundaries(self, data: np.ndarray) -> np.ndarray:
        """Positions of the certain cuts in the bytes of valid UTF-8 text."""
        if len(data) < 2:
            return np.zeros(0, dtype=np.int64)
        at = np.flatnonzero(self.cut[(data[:-1].astype(np.uint16) << 8) | data[1:]]) + 1
        high = at[data[at - 1] >= 0x80]
        if len(high):  # white space beyond ASCII on the left
            one, two, three = (data[np.maximum(high - k, 0)] for k in (1, 2, 3))
            space = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
            space |= (three == 0xE2) & (two == 0x80) & (((one >= 0x80) & (one <= 0x8A)) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
            space |= (three == 0xE2) & (two == 0x81) & (one == 0x9F)
            space |= (three == 0xE3) & (two == 0x80) & (one == 0x80)
            space |= (three == 0xE1) & (two == 0x9A) & (one == 0x80)
            if space.any():
                at = np.setdiff1d(at, high[space], assume_unique=True)
        return at

    def _ids(self, fragments: list[bytes]) -> list[bytes]:
        memo, known = self.memo, self.memo.known
        new = set(fragments).difference(known)
        long: dict[bytes, bytes] = {}
        rest = []
        tokenize, lead = self.tokenizer.model.tokenize, self.lead
        for f in new:
            text = f.decode()
            if len(f) <= MEMO_BYTES and _ONE_PRETOKEN(text) and not ((lead is None or lead in text) and self.added(text)):  # one word of the pattern: straight to the merges
                memo.put(f, array.array("i", [t.id for t in tokenize(stand_in(text))]).tobytes())
            else:
                rest.append(f)
        for lo in range(0, len(rest), 4_000):
            part = rest[lo : lo + 4_000]
            for f, e in zip(part, self.tokenizer.encode_batch([f.decode() for f in part], add_special_tokens=False)):
                ids = np.array(e.ids, dtype=np.int32).tobytes()
                if len(f) <= MEMO_BYTES:
                    memo.put(f, ids)
                else:
                    long[f] = ids
        out = [known[f] for f in fragments] if not long else [long[f] if f in long else known[f] for f in fragments]
        memo.bound()
        return out

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each text; null counts as empty.  Worked in slices of a few MB, whole texts each."""
        parts = [self._encode(texts.slice(lo, hi - lo)) for lo, hi in text_slices(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    def _encode(self, texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        whole = texts.buffers()[2]
        data = memoryview(whole)[offsets[0] : offsets[-1]] if whole is not None else memoryview(b"")
        offsets = offsets - offsets[0]
        raw = np.frombuffer(data, dtype=np.uint8)
        mark = np.zeros(len(raw) + 1, dtype=bool)
        mark[self.boundaries(raw)] = True
        mark[offsets] = True
        bounds = np.flatnonzero(mark)
        del mark
        values, counts = [], []
        for lo in range(0, len(bounds) - 1, FRAGMENTS_AT_ONCE):
            cuts = bounds[lo : lo + FRAGMENTS_AT_ONCE + 1].tolist()
            piece = bytes(data[cuts[0] : cuts[-1]])
            base = cuts[0]
            ids = self._ids([piece[s - base : e - base] for s, e in zip(cuts, cuts[1:])])
            counts.append(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) >> 2)
            values.append(b"".join(ids))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
        rows = ends[np.searchsorted(bounds, offsets)]
        return pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(np.frombuffer(b"".join(values), dtype=np.int32)))

    def decode(self, ids: pa.Array) -> pa.Array:
        """Text of each id list; ids beyond the vocabulary and null ids are left out, null lists
        give empty text, and bytes that are no UTF-8 become U+FFFD."""
        parts = [self._decode(ids.slice(lo, 512)) for lo in range(0, len(ids), 512)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    def _decode(self, ids: pa.Array) -> pa.Array:
        lists = pc.fill_null(ids.cast(pa.list_(pa.int32())), [])
        flat = lists.flatten()
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        values = pc.fill_null(flat, -1).to_numpy(zero_copy_only=False)
        table, n = self.table, len(self.table)
        sizes = np.fromiter(map(len, table), dtype=np.int64, count=n)
        known = (values >= 0) & (values < n)
        width = np.where(known, sizes[np.where(known, values, 0)], 0)
        parts = []
        for lo in range(0, len(values), 1 << 20):
            part = values[lo : lo + (1 << 20)]
            part = part[known[lo : lo + (1 << 20)]]
            parts.append(b"".join([table[i] for i in part.tolist()]))
        data = b"".join(parts)
        ends = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(lengths)])]
        raw = np.frombuffer(data, dtype=np.uint8)
        inner = ends[ends < len(raw)]
        try:
            data.decode()
            valid = not ((raw[inner] & 0xC0) == 0x80).any()
        except UnicodeDecodeError:
            valid = False
        if not valid:
            return pa.array([data[s:e].decode("utf-8", "replace") for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())], type=pa.string())
        return pa.StringArray.from_buffers(len(lists), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data))


def _coder(key: str, spec, ordinary: bool = False) -> ForcedBoundaryBPE:
    return resident(f"{key} {ordinary}", lambda: ForcedBoundaryBPE(spec.value, ordinary))


class Bpe:
    """Column functions of one tokenizer, and both directions in one pass over a table.

    path: a byte-level tokenizer file that the driver can read; its text (a few MB, whatever the
    corpus) is broadcast once.  `encode` takes a string column (null: empty list) to its ids as
    the tokenizers library gives them without special tokens added; `decode` takes ids back to
    text.  Very long texts are worked in slices of fragments.
    """

    def __init__(self, spark: SparkSession, path: str):
        text = open(path, encoding="utf-8").read()
        key, spec = hashlib.sha256(text.encode()).hexdigest(), spark.sparkContext.broadcast(text)
        self._key, self._spec = key, spec

        @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in lean(batches):
                yield _coder(key, spec).encode(texts)

        @F.arrow_udf(T.StringType())
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for ids in lean(batches):
                yield _coder(key, spec).decode(ids)

        self._encode, self._decode = encode, decode

    def worker(self, ordinary: bool = False) -> Callable[[], ForcedBoundaryBPE]:
        """What gives a worker its encoder and decoder."""
        key, spec = self._key, self._spec
        return lambda: _coder(key, spec, ordinary)

    def encode(self, text: Column | str) -> Column:
        return self._encode(text)

    def decode(self, ids: Column | str) -> Column:
        return self._decode(ids)

    def tokenized(self, docs: DataFrame, text: str = "text", *, ids: str = "ids", decoded: str | None = None) -> DataFrame:
        """docs without the text, with its ids and, if named, the text decoded from those ids:
        one worker a task, in slices of about a MB.  Columns named like the new ones are replaced;
        null and empty texts have no ids and decode to empty text; repeated rows are encoded each
        for itself; an empty table gives an empty result."""
        key, spec = self._key, self._spec
        kept = [f for f in docs.schema.fields if f.name not in (text, ids, decoded)]
        new = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))] + ([T.StructField(decoded, T.StringType())] if decoded else [])
        names = [f.name for f in [*kept, *new]]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder = _coder(key, spec)
            for batch in lean(batches):
                for lo, hi in text_slices(batch.column(len(kept)), 1 << 20):
                    part = batch.slice(lo, hi - lo)
                    own = coder._encode(part.column(len(kept)))
                    back = [coder._decode(own)] if decoded else []
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], own, *back], names=names)

        return docs.select(*[f.name for f in kept], text).mapInArrow(run, T.StructType([*kept, *new]))
