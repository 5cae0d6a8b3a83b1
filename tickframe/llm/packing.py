"""Packing: concatenate all documents' tokens and cut fixed windows.

Two passes.  The first encodes every document and keeps its ids beside its
place in the running total of its partition; the totals of the partitions,
one number each, give every partition its global offset by prefix sums.  The
second cuts each document at the multiples of the window; a document that
crosses one leaves a piece on either side of it (the boundary records).  All
sequences but the last are full.

Null text counts as empty: the document is its end id alone.  An empty table
gives no pieces.  Repeated rows are packed as often as they occur; columns
other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, pretokens

SEQUENCE = 2048
END_ID = 1
#: Partitions summed up in one group on the first level of the prefix sums.
BLOCK = 1024
#: Text bytes encoded at a time.
SLICE_BYTES = 4 << 20

#: Chunks whose normal form, case and pre-tokens need no library: letters that
#: are single code points in either case, then perhaps marks.
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-Þß-öø-þ]+", "[.,;:!?$%&#*|]"


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordEncoder:
    """Ids of chunks between blanks and line feeds, which no pre-token crosses."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.number = list(range(self.whole.get_vocab_size()))  # one object per id, shared by all cached tuples
        self.pieces, self.chunks = pretokens.Recent(), pretokens.Recent(10_000)

    def _piece(self, piece: str) -> tuple[int, ...]:
        """Ids of letters or marks that stand together, lower-cased."""
        ids = self.pieces.get(piece)
        if ids is None:
            ids = tuple(self.number[t.id] for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters)))
            self.pieces.put(piece, ids)
        return ids

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a chunk of any kind, by the library."""
        ids = self.chunks.get(chunk)
        if ids is None:
            ids = tuple(self.number[k] for k in self.whole.encode(chunk, add_special_tokens=False).ids)
            self.chunks.put(chunk, ids)
        return ids

    def encode(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunks in order, and where each chunk's begin.

        Plain chunks are cut into letters and marks by Arrow, and only distinct
        pieces are looked up: far fewer than chunks.
        """
        plain = pc.match_substring_regex(chunks, f"^{_LETTERS}{_MARKS}*$").to_numpy(zero_copy_only=False)
        there = chunks.filter(pa.array(plain))
        letters = pc.utf8_lower(pc.replace_substring_regex(there, f"{_MARKS}+$", ""))
        marks = pc.replace_substring_regex(there, f"^{_LETTERS}", "")
        coded = pa.concat_arrays([letters, marks]).dictionary_encode()
        ids = [self._piece(p) if p else () for p in coded.dictionary.to_pylist()]
        known = len(ids)
        ids += [self._chunk(c) for c in chunks.filter(pa.array(~plain)).to_pylist()]
        at = pretokens.starts(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(at[-1]))
        # two pieces of each chunk: letters and marks, or the whole chunk and nothing
        two, code, n = np.full((len(chunks), 2), -1, np.int64), coded.indices.to_numpy(), len(there)
        two[plain, 0], two[plain, 1] = code[:n], code[n:]
        two[~plain, 0] = known + np.arange((~plain).sum())
        size = np.where(two >= 0, (at[1:] - at[:-1])[two], 0)
        return pretokens.ragged(flat, at, two[two >= 0]), pretokens.starts(size.sum(1))


_ENCODERS: dict[str, WordEncoder] = {}


def encode_texts(texts: pa.Array, path: str, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per text with the end id, and all ids in order."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    n, codes, chunks = pretokens.blank_codes(texts)
    flat, at = _ENCODERS[path].encode(chunks)
    if end_id is not None:  # as a chunk of its own after each text
        codes = np.insert(codes.astype(np.int64), np.cumsum(n), len(chunks))
        flat, at = np.append(flat, np.uint32(end_id)), np.append(at, at[-1] + 1)
        n = n + 1
    first = pretokens.starts(n)
    upto = pretokens.starts((at[1:] - at[:-1])[codes])
    return upto[first[1:]] - upto[first[:-1]], pretokens.ragged(flat, at, codes)


def encode_partitions(df: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """First pass: (part, id, before, n, ids) with ``before`` the tokens ahead in the partition.

    ``ids`` are little-endian unsigned 32-bit integers.  A task that runs again
    reads the same split and so writes the same rows.
    """
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("id", df.schema[id_col].dataType),
                           T.StructField("before", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in pretokens.slices(batch, text, SLICE_BYTES):
                n, ids = encode_texts(rows.column(text), path)
                first = pretokens.starts(n)
                data = pa.BinaryArray.from_buffers(pa.binary(), len(n), [
                    None, pa.py_buffer((4 * first).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part), pa.int32()), rows.column(id_col), pa.array(total + first[:-1]), pa.array(n), data],
                    ["part", "id", "before", "n", "ids"])
                total += int(first[-1])
            common.tidy()

    return df.select(F.col(f"`{id_col}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def offsets(encoded: DataFrame) -> DataFrame:
    """(part, base, total): prefix sums of the partitions' token totals, on two levels.

    One row per input split, so its size is bounded by the number of splits.
    """
    totals = encoded.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("tokens"))
    totals = totals.withColumn("block", F.floor(F.col("part") / BLOCK))
    inner = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("tokens").alias("tokens"))
    outer = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("tokens").over(outer), F.lit(0)).alias("ahead"),
                           F.sum("tokens").over(Window.partitionBy()).alias("total"))
    return (totals.withColumn("inside", F.coalesce(F.sum("tokens").over(inner), F.lit(0))).join(blocks, "block")
            .select("part", (F.col("ahead") + F.col("inside")).alias("base"), "total"))


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", window: int = SEQUENCE) -> DataFrame:
    """Pieces (id, start, length, doc_tokens, sequence_id, offset, padded_to, ids), ``ids`` as in encode_partitions.

    ``padded_to`` is the length a sequence is padded to: the window, or its own
    length where that is a power of two.
    """
    encoded = common.write_scratch(encode_partitions(df, path, id_col, text), "packing")
    placed = encoded.join(F.broadcast(offsets(encoded)), "part")  # bounded: one row per input split
    placed = placed.select("id", "n", (F.col("base") + F.col("before")).alias("at"), "total", "ids")
    names = ("start", "length", "doc_tokens", "sequence_id", "offset", "padded_to")
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in names),
                           T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, at, total = (batch.column(c).to_numpy() for c in ("n", "at", "total"))
            if not len(n):
                continue
            first, last = at // window, (at + n - 1) // window
            pieces = last - first + 1
            row = np.repeat(np.arange(len(n)), pieces)
            to = pretokens.starts(pieces)
            seq = np.repeat(first - to[:-1], pieces) + np.arange(to[-1])
            begin, end = np.maximum(at[row], seq * window), np.minimum(at[row] + n[row], (seq + 1) * window)
            fill = np.minimum(total[row] - seq * window, window)
            padded = np.where(fill & (fill - 1) == 0, fill, window)
            # the pieces of a document are its ids in order, so the data buffer is cut, not copied
            col = batch.column("ids")
            ends = np.frombuffer(col.buffers()[1], np.int32, len(n) + 1, 4 * col.offset)
            cuts = np.append(ends[row] + 4 * (begin - at[row]), ends[-1]).astype(np.int32)
            data = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(cuts), col.buffers()[2]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row)), *(pa.array(x.astype(np.int64)) for x in (
                    begin - at[row], end - begin, n[row], seq, begin - seq * window, padded)), data], [id_col, *names, "ids"])

    return placed.mapInArrow(run, schema)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = pack(common.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to")
