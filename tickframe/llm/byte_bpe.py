"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a byte string exactly one token can be the last token of
its encoding.  ``Prefixes`` stores that token for each prefix, left to right:
a token t that ends a prefix is its last one if the rest's last token and t
are *compatible*, that is, the merge order would never join bytes across
their border.  Reading the stored tokens from the end gives the encoding.
Bytes can be appended without touching earlier entries, and after an edit
only the entries from its place on are computed again.

Null text encodes as empty: no ids, digests of the empty string.  Rows are
independent; other columns pass through, columns named like a result are
replaced.  Special strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from . import common, pretokens


class ByteBpe:
    """Ranks of a vocabulary, the two parts of every token, and compatibility."""

    def __init__(self, ranks: dict[bytes, int], pat: str):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for b, r in ranks.items():
            self.tokens[r] = b
        #: Ranks of all tokens, and -1 for what only begins one.
        self.begun = {b[:k]: -1 for b in ranks for k in range(1, len(b))} | ranks
        self.longest = max(map(len, ranks))
        self.parts = [self._halves(b, r) for r, b in enumerate(self.tokens)]
        self.pattern = pretokens.pattern(pat)
        self.compatible: dict[int, bool] = {}
        self.units, self.pre = pretokens.Recent(), pretokens.Recent()
        self.bytes_of = pa.array(self.tokens, pa.large_binary())
        self.digits = pa.array([str(r) for r in range(len(self.tokens))])

    @classmethod
    def load(cls, path: str, pat: str) -> ByteBpe:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pat)

    def _halves(self, token: bytes, rank: int) -> tuple[int, int]:
        """The two tokens whose merge gives this one; itself twice for a single byte."""
        parts = [token[k:k + 1] for k in range(len(token))]
        while len(parts) > 2:
            joined = [self.ranks.get(a + b, rank) for a, b in zip(parts, parts[1:], strict=False)]
            low = min(joined)
            if low >= rank:
                raise ValueError(f"token {rank} is not reached by merges")
            k = joined.index(low)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else (rank, rank)

    def fits(self, left: int, right: int) -> bool:
        """Whether merges leave the border between two adjacent tokens alone.

        Undo merges on both sides, latest first, so that at each step the
        tokens next to the border are those that existed at that time; a merge
        across the border that ranks before the one just undone would have
        come first.
        """
        key = left << 20 | right
        if (known := self.compatible.get(key)) is not None:
            return known
        tokens, get, parts = self.tokens, self.ranks.get, self.parts
        a, b, before = left, right, len(tokens)
        while True:
            across = get(tokens[a] + tokens[b])
            if across is not None and across < before:
                out = False
                break
            if len(tokens[a]) == 1 and len(tokens[b]) == 1:
                out = True
                break
            # of equal tokens, the left one was merged first, so the right one is undone first
            if len(tokens[b]) == 1 or (a > b and len(tokens[a]) > 1):
                before, a = a, parts[a][1]
            else:
                before, b = b + 1, parts[b][0]
        if len(self.compatible) > 1_000_000:
            self.compatible.clear()
        self.compatible[key] = out
        return out

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        return (whole,) if whole is not None else Prefixes(self, piece).ids()

    def encode_unit(self, unit: str) -> tuple[int, ...]:
        out: list[int] = []
        for p in self.pattern.findall(unit):
            ids = self.pre.get(p)
            if ids is None:
                ids = self.encode_piece(p.encode())
                self.pre.put(p, ids)
            out += ids
        return tuple(out)

    def encode_units(self, units: list[str]) -> list[tuple[int, ...]]:
        out = []
        for u in units:
            ids = self.units.get(u)
            if ids is None:
                ids = self.encode_unit(u)
                self.units.put(u, ids)
            out.append(ids)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for p in self.pattern.findall(text) for i in self.encode_piece(p.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.tokens[i] for i in ids)


class Prefixes:
    """The last token of every prefix of a byte string."""

    def __init__(self, bpe: ByteBpe, piece: bytes = b""):
        self.bpe, self.piece, self.last = bpe, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        old = len(self.piece)
        self.piece += more
        self.last += [-1] * len(more)
        self._fill(old)

    def replace(self, at: int, to: int, by: bytes) -> None:
        """Put ``by`` in place of the bytes at..to; entries up to ``at`` stay."""
        rest = by + self.piece[to:]
        self.piece, self.last = self.piece[:at], self.last[:at + 1]
        self.append(rest)

    def _fill(self, old: int) -> None:
        """Entries of the prefixes longer than ``old``; shorter ones are known."""
        bpe, piece, last = self.bpe, self.piece, self.last
        get, known, fits, n, longest = bpe.begun.get, bpe.compatible.get, bpe.fits, len(self.piece), bpe.longest
        for i in range(max(0, old - longest + 1), n):
            left = last[i]
            for j in range(i + 1, min(n, i + longest) + 1):
                t = get(piece[i:j])
                if t is None:
                    break
                if t >= 0 and last[j] < 0:
                    fit = i == 0 or known(left << 20 | t)
                    if fit or fit is None and fits(left, t):
                        last[j] = t

    def ids(self) -> tuple[int, ...]:
        out, i = [], len(self.piece)
        while i:
            t = self.last[i]
            out.append(t)
            i -= len(self.bpe.tokens[t])
        return tuple(reversed(out))


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def loaded(path: str, pat: str) -> ByteBpe:
    if (path, pat) not in _LOADED:
        _LOADED[path, pat] = ByteBpe.load(path, pat)
    return _LOADED[path, pat]


def encode_texts(texts: pa.Array, bpe: ByteBpe) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per text, and all ids in order."""
    n, codes, units = pretokens.byte_units(texts, bpe.pattern)
    ids = bpe.encode_units(units)
    at = pretokens.starts(np.fromiter(map(len, ids), np.int64, len(ids)))
    flat = np.fromiter((i for x in ids for i in x), np.int32, int(at[-1]))
    first = pretokens.starts(n)
    upto = pretokens.starts((at[1:] - at[:-1])[codes])
    return upto[first[1:]] - upto[first[:-1]], pretokens.ragged(flat, at, codes)


def encode_documents(df: DataFrame, path: str, pat: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (array of int) in place of its text."""
    from pyspark.sql import types as T

    keep = [c for c in df.columns if c not in (text, "ids")]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pretokens.slices(batch, text):
                n, ids = encode_texts(part.column(text), loaded(path, pat))
                lists = pa.ListArray.from_arrays(pa.array(pretokens.starts(n), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], [*keep, "ids"])

    return df.select(*[f"`{c}`" for c in (*keep, text)]).mapInArrow(run, schema)


def decode_documents(df: DataFrame, path: str, pat: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (binary) beside its ids; null ids decode as empty."""
    from pyspark.sql import types as T

    keep = [c for c in df.columns if c != "decoded"]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(ids)
            col = pc.if_else(pc.is_null(col), pa.scalar([], col.type), col)
            flat = loaded(path, pat).bytes_of.take(col.flatten())
            ends = pretokens.starts(pc.binary_length(flat).to_numpy(zero_copy_only=False))
            first = pretokens.starts(pc.list_value_length(col).to_numpy(zero_copy_only=False))
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(col), [None, pa.py_buffer(ends[first]), flat.buffers()[2]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), data.cast(pa.binary())], [*keep, "decoded"])

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, path: str, pat: str, text: str = "text") -> DataFrame:
    """Encode, decode and digest slice by slice, so that no ids leave the task."""
    from pyspark.sql import types as T

    new = ("n_tokens", "ids_sha256", "decoded_sha256")
    keep = [c for c in df.columns if c != text and c not in new]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pat)
        for batch in batches:
            for part in pretokens.slices(batch, text):
                n, ids = encode_texts(part.column(text), bpe)
                first = pretokens.starts(n)
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), bpe.digits.take(pa.array(ids)))
                joined = pc.binary_join(lists, " ").to_pylist()
                flat = bpe.bytes_of.take(pa.array(ids))
                ends = pretokens.starts(pc.binary_length(flat).to_numpy(zero_copy_only=False))[first]
                data = memoryview(flat.buffers()[2] or b"")
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(n, pa.int64()),
                     pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined], pa.string()),
                     pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())],
                    [*keep, *new])

    return df.select(*[f"`{c}`" for c in (*keep, text)]).mapInArrow(run, schema)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tok

    return digests(common.documents(spark, sf_dir).select("doc_id", "text"), tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN)
