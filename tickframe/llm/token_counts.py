"""Token counts without token ids.

In each task, Arrow gives the distinct units of a slice of texts; the
pre-tokens in them are counted once per distinct value by the tokenizer; the
per-document frequencies of units are joined to these counts by code and
summed.  Ids of a document are never built.

Null text counts as empty (0 bytes, 0 tokens); rows are independent, repeated
rows give repeated results, other columns pass through; a column named like
a result is replaced.  Special strings count as one token, the library's
default.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from . import common, pretokens

LIMIT = 512


class Counter:
    """Tokens of distinct units and pre-tokens."""

    def __init__(self, path: str):
        import json

        import public_tokenizers
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.special = tuple(x["content"] for x in json.load(f)["added_tokens"])
        self.pattern = pretokens.pattern(public_tokenizers.PATTERN)
        self.units, self.pre = pretokens.Recent(), pretokens.Recent()

    def counts(self, units: list[str]) -> np.ndarray:
        """Tokens of each of the distinct units."""
        out = [self.units.get(u) for u in units]
        new = [k for k, n in enumerate(out) if n is None]
        parts = {k: [units[k]] if units[k] in self.special else self.pattern.findall(units[k]) for k in new}
        pre = {p: self.pre.get(p) for ps in parts.values() for p in ps}
        missing = [p for p, n in pre.items() if n is None]
        for p, e in zip(missing, self.model.encode_batch_fast(missing, add_special_tokens=False), strict=True):
            pre[p] = len(e)
            self.pre.put(p, len(e))
        for k, ps in parts.items():
            out[k] = sum(pre[p] for p in ps)
            self.units.put(units[k], out[k])
        return np.array(out, np.int64)


_COUNTERS: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_texts(texts: pa.Array, path: str) -> np.ndarray:
    """Tokens of each text of an Arrow string array."""
    counter = _counter(path)
    n, codes, units = pretokens.byte_units(texts, counter.pattern, counter.special)
    if not len(codes):
        return np.zeros(len(texts), np.int64)
    # (document, unit, frequency), joined to the count of the unit and summed
    pair, freq = np.unique(np.repeat(np.arange(len(n)), n) * len(units) + codes, return_counts=True)
    per_unit = counter.counts(units)
    return np.bincount(pair // len(units), weights=freq * per_unit[pair % len(units)], minlength=len(n)).astype(np.int64)


def count_tokens(df: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``df`` without its text, with n_bytes, n_tokens and over_limit."""
    from pyspark.sql import types as T

    new = ("n_bytes", "n_tokens", "over_limit")
    keep = [c for c in df.columns if c != text and c not in new]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pretokens.slices(batch, text):
                col = part.column(text)
                n = count_texts(col, path)
                size = pc.fill_null(pc.binary_length(col), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [size, pa.array(n, pa.int64()), pa.array(n > limit)], [*keep, *new])

    return df.select(*[f"`{c}`" for c in (*keep, text)]).mapInArrow(run, schema)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(common.documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
