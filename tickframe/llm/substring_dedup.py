"""Exact removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of a document; a word goes if a
window that covers it also starts in a document with a smaller id.  The
minimiser of a window is its least hashed word trigram.  Consecutive windows
with one minimiser travel as one packed string (a super-k-mer) to the bucket
of that minimiser, so all equal windows meet in one bucket, where sorting
counts them; windows of equal hash are compared byte by byte.

1. Documents are written as blocks of a few MB, each a compressed row.
2. Each block sends every distinct super-k-mer once, with the least and the
   largest id that has it.  A passage in a third of all documents is one
   record per block, not one per document.
3. A bucket answers, per block, with the least id of each window, only for
   super-k-mers that lose a window there.
4. Blocks and answers meet by block; the windows are judged on the input, so
   the order of removal doesn't matter.

Null texts have no words and digest as empty.  Rows with a null id neither
lose words nor cause losses; rows that share an id don't cause losses in each
other.  Texts shorter than a window stay.  Other columns pass through, those
named like a result are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, pretokens, wordhash

WINDOW = 13
GRAM = 3
#: Text bytes of a block; a longer document makes a block of its own.
BLOCK_BYTES = 4 << 20
#: Windows of a super-k-mer; longer runs are cut, which loses no window.
LONGEST = 256
#: Buckets for each shuffle partition, so that a bucket's words fit in a task.
BUCKETS_PER_PARTITION = 8
RESULTS = ("n_words", "n_removed", "kept_sha256")

_BLOCK = "block long, packed binary"
_SENT = "bucket int, block long, at binary, low binary, spread binary, windows binary, words binary"
_ANSWER = "block long, at binary, windows binary, least binary"


def _pack(a: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=6).compress(a if isinstance(a, bytes) else a.tobytes())


def _unpack(b: bytes, kind=None):
    raw = zstandard.ZstdDecompressor().decompress(b)
    return raw if kind is None else np.frombuffer(raw, kind)


def blocks(df: DataFrame, text: str) -> DataFrame:
    """Rows of ``df`` as compressed Arrow streams of about BLOCK_BYTES of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0

        def block(rows: pa.Table) -> pa.RecordBatch:
            nonlocal k
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(rows)
            k += 1
            return pa.RecordBatch.from_pydict({"block": pa.array([(part << 32) + k], pa.int64()),
                                               "packed": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        held, size = [], 0
        for batch in batches:
            for rows in pretokens.slices(batch, text, BLOCK_BYTES):
                bytes_ = int(pc.sum(pc.binary_length(rows.column(text))).as_py() or 0)
                if held and size + bytes_ > BLOCK_BYTES:
                    yield block(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(rows)
                size += bytes_
        if held:
            yield block(pa.Table.from_batches(held))

    return df.mapInArrow(run, _BLOCK)


def _open(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all().combine_chunks()


def _column(t: pa.Table, name: str) -> pa.Array:
    col = t.column(name)
    return col.chunk(0) if col.num_chunks == 1 else pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)


class SuperKmers:
    """Super-k-mers of a block: where each starts, its windows, and the group of equal ones it belongs to."""

    def __init__(self, w: wordhash.Words, ids: pa.Array):
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        doc = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        n = np.diff(w.first)
        owner = np.repeat(np.arange(len(n)), n)
        whole = known[owner] & (np.arange(len(owner)) + WINDOW <= w.first[1:][owner])
        at = np.flatnonzero(whole)
        if not len(at):
            self.start = self.windows = self.doc = self.group = self.low = self.high = self.first = self.minimiser = np.zeros(0, np.int64)
            return
        low = wordhash.runs(w.hash, GRAM)
        span, want = 1, WINDOW - GRAM + 1
        while span < want:  # least of `want` neighbours by doubling
            step = min(span, want - span)
            low = np.minimum(low[:-step], low[step:])
            span += step
        low = low[at]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (low[1:] != low[:-1])
        begin = np.flatnonzero(new)
        run = np.diff(np.append(begin, len(at)))
        if run.max() > LONGEST:
            new |= (np.arange(len(at)) - np.repeat(begin, run)) % LONGEST == 0
            begin = np.flatnonzero(new)
            run = np.diff(np.append(begin, len(at)))
        self.start, self.windows, self.doc = at[begin], run, doc[owner[at[begin]]]
        end = self.start + run + WINDOW - 1
        one = wordhash.span_hash(wordhash.prefix_hash(w.hash), self.start, end)
        two = wordhash.span_hash(wordhash.prefix_hash(wordhash.mix(w.hash ^ np.uint64(0xA0761D6478BD642F))), self.start, end)
        order = np.lexsort((two, one))
        edge = np.ones(len(order), bool)
        edge[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        heads = np.flatnonzero(edge)
        first = order[heads]  # the sort is stable: the first member of each group in the text
        rank = np.empty(len(heads), np.int64)
        turn = np.argsort(first)  # groups are numbered as they appear, so that neighbours are alike
        rank[turn] = np.arange(len(heads))
        self.group = np.empty(len(order), np.int64)
        self.group[order] = rank[np.cumsum(edge) - 1]
        self.low = np.minimum.reduceat(self.doc[order], heads)[turn]
        self.high = np.maximum.reduceat(self.doc[order], heads)[turn]
        self.first = first[turn]
        self.minimiser = low[begin][self.first]


def send(blocks_: DataFrame, id_col: str, text: str, buckets: int) -> DataFrame:
    """One row for each block and bucket, with the block's distinct super-k-mers of that bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("packed"), strict=True):
                rows = _open(packed.as_py())
                w = wordhash.words(_column(rows, text))
                s = SuperKmers(w, _column(rows, id_col))
                if not len(s.first):
                    continue
                data, begin, end = wordhash.joined(w)
                raw, a, n = data.tobytes(), begin[s.start[s.first]], s.windows[s.first]
                b = end[s.start[s.first] + n + WINDOW - 2]
                bucket = (wordhash.mix(s.minimiser) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                out = {k: [] for k in ("bucket", "block", "at", "low", "spread", "windows", "words")}
                for g in np.split(order, cuts):
                    out["bucket"].append(int(bucket[g[0]]))
                    out["block"].append(block)
                    out["at"].append(_pack(np.diff(g, prepend=0).astype(np.int32)))
                    out["low"].append(_pack(np.diff(s.low[g], prepend=0)))
                    out["spread"].append(_pack((s.high - s.low)[g]))
                    out["windows"].append(_pack(n[g].astype(np.int32)))
                    out["words"].append(_pack(b"\n".join([raw[x:y] for x, y in zip(a[g].tolist(), b[g].tolist(), strict=True)])))
                common.tidy()
                yield pa.RecordBatch.from_arrays([
                    pa.array(out["bucket"], pa.int32()), pa.array(out["block"], pa.int64()),
                    *(pa.array(out[k], pa.binary()) for k in ("at", "low", "spread", "windows", "words"))], list(out))

    return blocks_.mapInArrow(run, _SENT)


def least_ids(strings: list[bytes], windows: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each window of distinct super-k-mers in turn, the least id that has it."""
    lines = b"\n".join(strings)
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    w = wordhash.words(pa.array([lines], pa.large_binary()))
    first = np.searchsorted(w.begin, np.cumsum(size + 1) - size - 1)
    at = np.repeat(first - pretokens.starts(windows)[:-1], windows) + np.arange(windows.sum())
    h = wordhash.span_hash(wordhash.prefix_hash(w.hash), at, at + WINDOW)
    own = np.repeat(low, windows)
    order = np.argsort(h, kind="stable")
    edge = np.ones(len(h), bool)
    edge[1:] = h[order][1:] != h[order][:-1]
    heads = np.flatnonzero(edge)
    out = np.empty(len(h), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(own[order], heads), np.diff(np.append(heads, len(h))))
    # equal hashes: the words decide
    begin, end = w.begin[at], w.end[at + WINDOW - 1]
    for k in np.flatnonzero(np.diff(np.append(heads, len(h))) > 1):
        group = order[heads[k]:heads[k + 1] if k + 1 < len(heads) else len(h)]
        texts = [lines[a:b] for a, b in zip(begin[group].tolist(), end[group].tolist(), strict=True)]
        if any(t != texts[0] for t in texts):
            per: dict[bytes, int] = {}
            for t, i in zip(texts, own[group].tolist(), strict=True):
                per[t] = min(i, per.get(t, i))
            out[group] = [per[t] for t in texts]
    return out




def answer(table: pa.Table) -> pa.Table:
    """For one bucket: per block, the least ids of the windows of super-k-mers that lose one there."""
    common.tidy()
    known: dict[bytes, int] = {}
    strings, windows, low, records = [], [], [], []
    for row in range(table.num_rows):
        cell = {c: table.column(c)[row].as_py() for c in ("block", "at", "low", "spread", "windows", "words")}
        mine = _unpack(cell["words"]).split(b"\n")
        least_here, n = np.cumsum(_unpack(cell["low"], np.int64)), _unpack(cell["windows"], np.int32)
        lows = least_here.tolist()
        which = np.empty(len(mine), np.int64)
        for k, s in enumerate(mine):
            g = known.get(s)
            if g is None:
                g = known[s] = len(strings)
                strings.append(s)
                windows.append(n[k])
                low.append(lows[k])
            elif lows[k] < low[g]:
                low[g] = lows[k]
            which[k] = g
        records.append((cell["block"], np.cumsum(_unpack(cell["at"], np.int32)), least_here + _unpack(cell["spread"], np.int64), which))
    windows, low = np.array(windows, np.int64), np.array(low, np.int64)
    least = least_ids(strings, windows, low)
    to = pretokens.starts(windows)
    smallest = np.minimum.reduceat(least, to[:-1])
    out = {"block": [], "at": [], "windows": [], "least": []}
    for block, at, high, which in records:
        lost = np.flatnonzero(smallest[which] < high)
        if len(lost):
            out["block"].append(block)
            out["at"].append(_pack(np.diff(at[lost], prepend=0).astype(np.int32)))
            out["windows"].append(_pack(windows[which[lost]].astype(np.int32)))
            out["least"].append(_pack(pretokens.ragged(least, to, which[lost])))
    return pa.table({"block": pa.array(out["block"], pa.int64()), **{c: pa.array(out[c], pa.binary()) for c in ("at", "windows", "least")}})


def removed_words(w: wordhash.Words, s: SuperKmers, answers: pa.Table) -> np.ndarray:
    """Whether each word of a block goes."""
    cover = np.zeros(len(w.hash) + 1, np.int64)
    groups = len(s.first)
    size = np.zeros(groups, np.int64)
    parts = [(np.cumsum(_unpack(answers.column("at")[k].as_py(), np.int32)), _unpack(answers.column("windows")[k].as_py(), np.int32),
              _unpack(answers.column("least")[k].as_py(), np.int64)) for k in range(answers.num_rows)]
    if parts:
        at = np.concatenate([p[0] for p in parts])
        n = np.concatenate([p[1] for p in parts]).astype(np.int64)
        least = np.concatenate([p[2] for p in parts])
        size[at] = n
        begin = np.zeros(groups, np.int64)
        begin[at] = pretokens.starts(n)[:-1]
        here = np.flatnonzero(size[s.group] > 0)
        n = s.windows[here]
        step = np.arange(n.sum()) - np.repeat(pretokens.starts(n)[:-1], n)
        goes = least[np.repeat(begin[s.group[here]], n) + step] < np.repeat(s.doc[here], n)
        starts = (np.repeat(s.start[here], n) + step)[goes]
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + WINDOW, -1)
    return np.cumsum(cover[:-1]) > 0


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """``df`` with its text less the repeated passages, n_words, n_removed and kept_sha256.

    A text that loses words becomes its kept words joined by one blank; others
    stay as they are.  Without ``with_text`` the text is left out.
    """
    spark = df.sparkSession
    df = df.select(*[f"`{c}`" for c in df.columns if c not in RESULTS])
    df = df.withColumn(id_col, F.col(f"`{id_col}`").cast("long"))
    packed = common.write_scratch(blocks(df, text), "blocks")
    buckets = BUCKETS_PER_PARTITION * common.task_count(spark)
    answers = send(packed, id_col, text, buckets).groupBy("bucket").applyInArrow(answer, _ANSWER)
    keep = [c for c in df.columns if with_text or c != text]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        common.tidy()
        rows = _open(left.column("packed")[0].as_py())
        col = _column(rows, text)
        w = wordhash.words(col)
        gone = removed_words(w, SuperKmers(w, _column(rows, id_col)), right)
        data, begin, end = wordhash.joined(w)
        stay = np.repeat(~gone, end - begin + 1)
        upto = pretokens.starts(np.where(gone, 0, end - begin + 1))[w.first]
        raw = memoryview(data[stay].tobytes())
        lost = pretokens.starts(gone.astype(np.int64))[w.first]
        kept = [raw[a:max(a, b - 1)] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
        n_removed = np.diff(lost)
        cols = {c: _column(rows, c) for c in keep}
        if with_text:
            hit = np.flatnonzero(n_removed)
            cols[text] = pc.replace_with_mask(col, pa.array(n_removed > 0), pa.array([str(kept[k], "utf-8") for k in hit], col.type))
        return pa.table([*cols.values(), pa.array(np.diff(w.first), pa.int64()), pa.array(n_removed, pa.int64()),
                         pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())], [*keep, *RESULTS])

    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(apply, schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    return remove_repeats(docs, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = f"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + {WINDOW - 1}), ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW} + 2)) AS i FROM w)),
least AS (SELECT g, min(doc_id) AS first FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS pos FROM win JOIN least USING (g) WHERE first < doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
