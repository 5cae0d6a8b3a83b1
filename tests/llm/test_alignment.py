"""Tokenizer alignment against a plain version with the two libraries."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tickframe.llm import alignment

ODD = [
    "plain words, twice twice", "plain words, twice twice", "plain words, twice twice", "", None, " ", "  two  blanks \n\n and\ttabs x ",
    "wörld 日本語 é é ﬁ ½", "has ▁ in it", "<|endoftext|> and </s><s> <unk> <0x41>", "a" * 3000, "x", "\u0000nul", "🙂🙃 mixed-up",
    "word " * 4000, "no-blank-" * 2000, "　wide", "tail\n",
]


def plain(texts: list[str | None]) -> list[dict]:
    byte = {v: k for k, v in ((c, b) for c, b in alignment._byte_alphabet().items())}
    byte = {c: b for b, c in byte.items()}
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows, count = [], Counter()
    for t in texts:
        a, b = [], []
        if t:
            e = a_model.encode(" " + t, add_special_tokens=False)
            a = [(i, bytes(byte[c] for c in tok)) for i, tok in zip(e.ids, e.tokens, strict=True)]
            for i in b_model.encode(t):
                p = b_model.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()))
            want = (" " + t).encode()
            if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
                a, b = [], []
        ends: list[dict] = []
        for tokens in (a, b):
            at, found = 0, defaultdict(list)
            for k, (_, raw) in enumerate(tokens):
                at += len(raw)
                found[at].append(k)
            ends.append(found)
        both = sorted(set(ends[0]) & set(ends[1]))
        links = [(a[x][0], b[y][0]) for e in both for x in ends[0][e] for y in ends[1][e]]
        groups, x0, y0 = [], 0, 0
        for e in both:
            x1, y1 = max(ends[0][e]) + 1, max(ends[1][e]) + 1
            groups.append(",".join(str(i) for i, _ in a[x0:x1]) + "|" + ",".join(str(i) for i, _ in b[y0:y1]))
            x0, y0 = x1, y1
        count.update(links)
        rows.append({"n_a": len(a), "n_b": len(b), "n_groups": len(both), "links": links, "groups": ";".join(groups)})
    top: dict[int, int] = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    for r in rows:
        links = r.pop("links")
        r |= {"n_links": len(links), "n_best": sum(count[p] == top[p[1]] for p in links), "count_sum": sum(count[p] for p in links),
              "groups_sha256": hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else ""}
    return rows


def rows_of(df) -> dict:
    return {r["doc_id"]: {k: v for k, v in r.asDict().items() if k != "doc_id"} for r in df.collect()}


def test_odd_texts(spark):
    df = spark.createDataFrame([(k, t, k) for k, t in enumerate(ODD)], "doc_id long, text string, n_a int").repartition(3)
    want = plain(ODD)
    got, pairs = alignment.align(df)
    got = rows_of(got)
    assert len(got) == len(ODD)
    for k, w in enumerate(want):
        assert got[k] == {c: v for c, v in w.items() if c != "groups_sha256"}, ODD[k]
    digest = rows_of(alignment.align(df, groups=False)[0])
    assert all(digest[k] == {c: v for c, v in w.items() if c != "groups"} for k, w in enumerate(want))
    assert pairs.count() == pairs.select("a", "b").distinct().count() > 0


def test_small_blocks_and_hot_texts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "HOT_SHARE", 3)
    texts = ["hot text of many copies"] * 40 + [f"text {k} of some words" for k in range(25)] + [None, ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = rows_of(alignment.align(df, groups=False)[0])
    assert [got[k] for k in range(len(texts))] == [{c: v for c, v in w.items() if c != "groups"} for w in plain(texts)]


def test_empty_table_null_ids_and_repeats(spark):
    schema = "doc_id long, text string"
    assert alignment.align(spark.createDataFrame([], schema))[0].count() == 0
    df = spark.createDataFrame([(None, "some text"), (1, "some text"), (1, "some text"), (2, None)], schema)
    got = alignment.align(df)[0].collect()
    assert sorted((r["doc_id"] or 0, r["n_links"] > 0) for r in got) == [(0, True), (1, True), (1, True), (2, False)]
    assert {r["count_sum"] for r in got if r["n_links"]} == {3 * got[0]["n_links"]} or len({r["count_sum"] for r in got if r["n_links"]}) == 1


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_plain(spark, sf):
    path = f"/root/testdata/{sf}"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    got = rows_of(alignment.op11_tokenizer_alignment(spark, path))
    want = plain([t for _, t in docs])
    assert len(got) == len(docs)
    for (d, _), w in zip(docs, want, strict=True):
        assert got[d] == {c: v for c, v in w.items() if c != "groups"}
