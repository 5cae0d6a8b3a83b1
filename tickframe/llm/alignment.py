"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled by their full content and grouped; each distinct text is
tokenised by both tokenizers, and its tokens are aligned on the byte offsets
where a token of either side ends.  Two tokens that end together are a *link*;
the links between such offsets cut the text into groups.

Links are counted over the whole corpus, each text's as often as the text
occurs.  A slice of texts is a block: it keeps its links as codes into the
block's own dictionary of distinct pairs, so that what is shuffled for the
counts is one row per block and distinct pair, never one per link.  The counts
come back to the blocks the same way, are summed per text, and the measures of
a text are joined to all documents that have it, by the SHA-256 of the text.
Texts with very many copies are dealt over several tasks in that join.

Null and empty texts, and texts that a tokenizer does not give back byte by
byte (its normalisation changed them), have no tokens: all measures are 0 and
``groups_sha256`` is empty.  Repeated rows, ids and ties are independent: every
row of the input gives one row.  Columns other than the id and the text are not
read, so their names can't clash.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, pretokens

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Text bytes of a block; a longer text makes a block of its own.
BLOCK_BYTES = 4 << 20
#: A text with more than this share of all documents is dealt over several tasks.
HOT_SHARE = 1000


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that print stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Side:
    """The bytes of every token of a vocabulary and their number."""

    def __init__(self, tokens: list[bytes]):
        self.bytes_of = pa.array(tokens, pa.large_binary())
        self.size = np.array([len(t) for t in tokens], np.int64)


class ByteLevel(_Side):
    """A byte-level tokenizer of the tokenizers library; a blank goes before the text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # special strings inside texts are plain text
        self.model.no_truncation()
        self.model.no_padding()
        byte = _byte_alphabet()
        tokens = [b""] * self.model.get_vocab_size(with_added_tokens=True)
        for t, k in self.model.get_vocab(with_added_tokens=True).items():
            tokens[k] = bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
        super().__init__(tokens)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces(_Side):
    """A sentencepiece model, which adds the blank itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        super().__init__([bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode()
                          for k, p in enumerate(map(self.model.id_to_piece, range(self.model.vocab_size())))])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


_SIDES: dict[str, _Side] = {}


def side(name: str) -> _Side:
    """The tokenizer of a vocabulary file, loaded once per worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    if name not in _SIDES:
        path = common.vocabulary(name)
        _SIDES[name] = Pieces(path) if path.endswith(".model") else ByteLevel(path)
    return _SIDES[name]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in order, and where each text's begin."""
    at = pretokens.starts(np.fromiter(map(len, lists), np.int64, len(lists)))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(at[-1])), at


def _joined(s: _Side, ids: np.ndarray) -> bytes:
    return bytes(s.bytes_of.take(pa.array(ids)).buffers()[2] or b"")[:int(s.size[ids].sum())]


class Aligned:
    """The alignment of a list of distinct texts."""

    def __init__(self, texts: list[str], a: _Side, b: _Side):
        want = [b" " + t.encode() for t in texts]
        ids_a, at_a = _flat(a.encode(texts))
        ids_b, at_b = _flat(b.encode(texts))
        good = np.ones(len(texts), bool)
        for s, ids, at in ((a, ids_a, at_a), (b, ids_b, at_b)):
            got, ends = _joined(s, ids), pretokens.starts(s.size[ids])[at]
            if got != b"".join(want):
                good &= [got[x:y] == w for x, y, w in zip(ends[:-1], ends[1:], want, strict=True)]
        good &= [t != "" for t in texts]
        keep_a, keep_b = np.repeat(good, np.diff(at_a)), np.repeat(good, np.diff(at_b))
        self.a, self.b = ids_a[keep_a], ids_b[keep_b]
        self.n_a, self.n_b = np.where(good, np.diff(at_a), 0), np.where(good, np.diff(at_b), 0)
        # both sides now have the same bytes, so one offset over all texts serves as position
        end_a, end_b = np.cumsum(a.size[self.a]), np.cumsum(b.size[self.b])
        ends = np.zeros((2, int(end_a[-1]) + 1 if len(end_a) else 1), bool)
        ends[0, end_a], ends[1, end_b] = True, True
        #: Tokens up to and with each common end; the last ones before it are linked.
        self.upto_a, self.upto_b = np.flatnonzero(ends[1, end_a]) + 1, np.flatnonzero(ends[0, end_b]) + 1
        common_ends = end_a[self.upto_a - 1]
        self.links = self.a[self.upto_a - 1] << 32 | self.b[self.upto_b - 1]
        text_ends = np.cumsum([len(w) if g else 0 for w, g in zip(want, good, strict=True)])
        self.n_links = np.diff(np.searchsorted(common_ends, text_ends, side="right"), prepend=0)

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text: the ids of each group, empty without tokens."""
        size_a, size_b = np.diff(self.upto_a, prepend=0), np.diff(self.upto_b, prepend=0)
        # in the written order each group's A tokens come before its B tokens
        place_a = np.arange(len(self.a)) + np.repeat(self.upto_b - size_b, size_a)
        place_b = np.arange(len(self.b)) + np.repeat(self.upto_a, size_b)
        last_a, last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        last_a[self.upto_a - 1], last_b[self.upto_b - 1] = True, True
        top = int(max(self.a.max(initial=0), self.b.max(initial=0))) + 1
        digits = pa.array([f"{k}{mark}" for mark in ",|;" for k in range(top)], pa.large_binary())
        words = np.zeros(len(self.a) + len(self.b), np.int64)
        words[place_a], words[place_b] = self.a + top * last_a, self.b + 2 * top * last_b
        flat = digits.take(pa.array(words))
        data = memoryview(flat.buffers()[2] or b"")
        ends = pretokens.starts(pc.binary_length(flat).to_numpy(zero_copy_only=False))[np.cumsum(self.n_a + self.n_b)]
        starts = np.concatenate([[0], ends[:-1]])
        return [str(data[x:max(x, y - 1)], "ascii") for x, y in zip(starts, ends, strict=True)]


_ROWS = ("kind string, block binary, key binary, copies long, n_a long, n_b long, n_groups long, groups string, "
         "codes binary, pos int, pair long, weight long")


def _blocks(texts: DataFrame, a: str, b: str, groups: bool) -> DataFrame:
    """Rows of kind ``text`` (one per distinct text) and ``pair`` (one per block and distinct pair)."""
    import pyspark.sql.pandas.types as pt
    from pyspark.sql import types as T

    schema = T._parse_datatype_string(_ROWS)
    arrow = pt.to_arrow_schema(schema)

    def table(n: int, **cols) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pretokens.slices(batch, "text", BLOCK_BYTES):
                keys, copies = part.column("key").to_pylist(), part.column("copies").to_numpy()
                found = Aligned(part.column("text").to_pylist(), side(a), side(b))
                pairs, codes = np.unique(found.links, return_inverse=True)
                weight = np.bincount(codes, np.repeat(copies, found.n_links).astype(np.float64), len(pairs)).astype(np.int64)
                codes, at = codes.astype(np.int32), pretokens.starts(found.n_links)
                written = found.groups()
                if not groups:
                    written = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in written]
                n = part.num_rows
                yield table(n, kind=["text"] * n, block=[keys[0]] * n, key=keys, copies=copies, n_a=found.n_a, n_b=found.n_b,
                            n_groups=found.n_links, groups=written, codes=[codes[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)])
                if m := len(pairs):
                    yield table(m, kind=["pair"] * m, block=[keys[0]] * m, pos=np.arange(m, dtype=np.int32), pair=pairs, weight=weight)

    return texts.mapInArrow(run, schema)


_MEASURES = "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _measure(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """The measures of a block's texts from the corpus-wide counts of its dictionary."""
    order = np.argsort(pairs["pos"].to_numpy())
    count, best = pairs["count"].to_numpy()[order], pairs["best"].to_numpy()[order].astype(np.int64)
    codes = np.frombuffer(b"".join(texts["codes"].to_pylist()), np.int32)
    at = pretokens.starts(texts["n_groups"].to_numpy())

    def per_text(x: np.ndarray) -> pa.Array:
        return pa.array(np.diff(pretokens.starts(x)[at]), pa.int64())

    every = np.ones(len(codes), np.int64)
    return pa.table([*(texts[c] for c in ("key", "copies", "n_a", "n_b", "n_groups")), per_text(every), per_text(best[codes]),
                     per_text(count[codes]), texts["groups"]],
                    ["key", "copies", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])


def align(df: DataFrame, a: str = A_FILE, b: str = B_FILE, id_col: str = "doc_id", text: str = "text",
          groups: bool = True) -> tuple[DataFrame, DataFrame]:
    """(measures, pairs) of a corpus.

    ``measures``: one row per row of ``df``: its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair is the most frequent one of its B token), ``count_sum`` (of the
    links' pair counts) and ``groups`` (the aligned ids in writing; with ``groups=False`` their
    SHA-256).  ``pairs``: ``a``, ``b``, ``count`` and ``best`` of every linked pair of ids.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    sha = F.unhex(F.sha2("text", 256))
    texts = docs.filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies")).withColumn("key", sha)
    blocks = common.write_scratch(_blocks(texts, a, b, groups), "aligned", ["kind"])
    entries = blocks.filter("kind = 'pair'")
    counts = common.write_scratch(entries.groupBy("pair").agg(F.sum("weight").alias("count")), "pairs")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    top = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("top"))
    counts = counts.withColumn("b", b_id).join(top, "b").select(
        "pair", F.shiftright("pair", 32).alias("a"), "b", "count", (F.col("count") == F.col("top")).alias("best"))
    known = entries.select("block", "pos", "pair").join(counts.select("pair", "count", "best"), "pair").select(
        F.col("block").alias("of"), "pos", "count", "best")
    rows = blocks.filter("kind = 'text'").select("block", "key", "copies", "n_a", "n_b", "n_groups", "groups", "codes")
    measures = rows.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_measure, _MEASURES)
    measures = common.write_scratch(measures, "measures")
    # texts with many copies are dealt over several tasks; there are HOT_SHARE of them at most
    total = measures.agg(F.sum("copies")).first()[0] or 0
    least = total // HOT_SHARE + 1
    parts = F.ceil(F.col("copies") / least).cast("int")
    hot = measures.filter(F.col("copies") >= least).select("key", parts.alias("parts"))
    left = docs.select("id", F.when(F.col("text") != "", sha).alias("key")).join(F.broadcast(hot), "key", "left")
    # rows without a key find nothing, so they go anywhere
    left = left.withColumn("salt", F.when(F.col("key").isNull(), F.pmod(F.xxhash64("id"), F.lit(1 << 20)).cast("int")).otherwise(
        F.coalesce(F.pmod(F.xxhash64("id"), "parts").cast("int"), F.lit(0)))).drop("parts")
    right = measures.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col("copies") >= least, parts - 1).otherwise(0)))).drop("copies")
    out = left.join(right, ["key", "salt"], "left")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    out = out.select(F.col("id").alias(id_col), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                     F.coalesce("groups", F.lit("")).alias("groups" if groups else "groups_sha256"))
    return out, counts.drop("pair")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(common.documents(spark, sf_dir), groups=False)[0]
