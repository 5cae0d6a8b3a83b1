"""The training-data operators against brute force, the libraries and SQL, on small tables with every odd case."""

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers as tok
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tickframe.llm import (byte_bpe, chat, components, embedding_dedup, language, licenses, near_dup, packing, pretokens, quality,
                           queries, substring_dedup, token_counts, wordhash)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, n int, kept string, bucket int"


def odd_texts():
    rng = random.Random(5)
    words = ["the", "Of", "é", "aa", "bb,", "cc.", "###", "漢字", "x" * 300, "don't", "</s>", "<|endoftext|>", "1 2", "\x01", "\x1c", "\x85"]
    base = " ".join(rng.choices(words, k=60))
    passage = " ".join(f"p{k}" for k in range(60))
    out = [None, "", " ", "\n\t \r\n", "one", "two words", "a b c", "A B C", "  lead and  trail \n", base, base, base.upper(), base + " tail",
           passage, "before " + passage + " after", passage + "\n\nx", "x " * 400, "ab " * 30 + ". Licensed under CC BY-NC 4.0.",
           "Released under the MIT License.\nAll rights reserved.\nAll rights reserved.", "end  of<|endoftext|> text<|endoftext|>"]
    out += [" ".join(rng.choices(words, k=rng.randint(1, 80))) for _ in range(25)]
    out.append(" ".join(f"w{rng.randint(0, 9000)}" for _ in range(30_000)))  # very long
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(10 * k, t, [None, "en", "de"][k % 3], "s", 0, "clash", 1, "clash", 7) for k, t in enumerate(odd_texts())]
    rows += [rows[9], rows[9], rows[13]]  # repeated rows
    rows += [(None, "a b c", "en", None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def words_of(text):
    return WORD.findall(text or "")


def same_as_sql(spark, name, sf=SF, tables=("documents", "embeddings", "conversations")):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(queries.SQL[name]).df()
    got = queries.QUERIES[name](spark, sf).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    assert by_row(got[cols].itertuples(index=False)) == by_row(want[cols].itertuples(index=False))
    return got


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    assert len(same_as_sql(spark, name))


# ---------------------------------------------------------------- packing

def test_packing(spark, docs, none):
    path = tok.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    window = 256
    got = packing.pack(docs, path, window=window).collect()
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(lib.encode(r.text or "", add_special_tokens=False).ids + [1])
    total = sum(len(i) for v in want.values() for i in v)
    places = sorted((r.sequence_id * window + r.offset, r.length) for r in got)
    assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(places[-1]) == total
    pieces = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.offset + r.length <= window
        if r.start == 0:
            pieces[r.doc_id].append([])
        assert len(pieces[r.doc_id][-1]) == r.start
        pieces[r.doc_id][-1] += ids
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    last = max(r.sequence_id for r in got)
    fill = total - last * window
    assert {r.padded_to for r in got if r.sequence_id == last} == {fill if fill & (fill - 1) == 0 else window}
    assert packing.pack(none, path).count() == 0


def test_packing_query(spark):
    lib = Tokenizer.from_file(tok.path("word_bpe_49k.json"))
    docs = {r.doc_id: np.array(lib.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
            for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = packing.op1_packing(spark, SF).collect()
    assert sum(r.length for r in got) == sum(map(len, docs.values()))
    for r in got:
        ids = docs[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())


# ---------------------------------------------------------------- substring dedup

def repeats(rows):
    least = {}
    for i, text in rows:
        w = words_of(text)
        for k in range(len(w) - 12):
            if i is not None:
                g = tuple(w[k:k + 13])
                least[g] = min(i, least.get(g, i))
    out = []
    for i, text in rows:
        w, gone = words_of(text), set()
        for k in range(len(w) - 12):
            if i is not None and least[tuple(w[k:k + 13])] < i:
                gone |= set(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return by_row(out)


def test_substring_dedup(spark, docs, none, monkeypatch):
    got = substring_dedup.remove_repeats(docs)
    want = repeats([(r.doc_id, r.text) for r in docs.collect()])
    assert by_row(got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()) == want
    assert any(r[2] for r in want) and set(docs.columns) <= set(got.columns)
    untouched = got.filter("n_removed = 0").select("doc_id", "text").collect()
    before = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    assert {tuple(r) for r in untouched} <= before
    assert substring_dedup.remove_repeats(none).count() == 0


def test_substring_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert by_row(substring_dedup.op2_substring_dedup(spark, SF).collect()) == repeats(rows)


def test_windows_of_equal_hash_are_told_apart(monkeypatch):
    words = [b" ".join(b"%d" % (k + j) for j in range(13)) for k in (0, 100, 0)]
    monkeypatch.setattr(wordhash, "span_hash", lambda p, a, b: np.zeros(len(a), np.uint64))
    assert substring_dedup.least_ids(words, np.array([1, 1, 1]), np.array([5, 7, 3])).tolist() == [3, 7, 3]


# ---------------------------------------------------------------- near duplicates

def shingles(text, k):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words_of(text)]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def groups(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return by_row((i, len(shingles(t, k)), find(i) if i is not None else None, None if i is None else find(i) == i) for i, t in rows)


def test_near_dedup(spark, docs, none):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert by_row(near_dup.near_duplicates(docs, shingle=3, percent=85).collect()) == groups(rows, 3, 85)
    assert near_dup.near_duplicates(none).count() == 0


def test_near_dedup_across_components(spark, monkeypatch):
    """A group whose least member links with few: the rest must be found by the second comparison, in several blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rng = random.Random(3)
    base = [f"b{k}" for k in range(300)]
    rows = []
    for i in range(40):
        w = list(base)
        for p in rng.sample(range(300), 6 if i else 12):
            w[p] = f"c{i}-{p}"
        rows.append((i, " ".join(w)))
    rows.append((99, " ".join(base)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85)
    assert by_row(got.collect()) == groups(rows, 3, 85)


def test_near_dedup_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert by_row(near_dup.op3_near_dedup(spark, SF).collect()) == groups(rows, 3, 85)


def test_likelihood_keeps_true_links():
    rng = np.random.default_rng(1)
    for share in (0.85, 0.9, 0.99):
        for n in (20, 200, 2000):
            both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            extra = max(1, int(n / share - n))
            a, b = both, np.concatenate([both, rng.integers(0, 1 << 63, extra, dtype=np.uint64)])
            r = [near_dup.registers(x)[None] for x in (a, b)]
            if 100 * len(a) >= 85 * len(b):
                assert near_dup.may_reach(*r, np.array([len(a)]), np.array([len(b)]), 85)[0]
    r = [near_dup.registers(rng.integers(0, 1 << 63, 500, dtype=np.uint64))[None] for _ in range(2)]
    assert not near_dup.may_reach(*r, np.array([500]), np.array([500]), 85)[0]


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(k, k + 1) for k in range(1000, 1040)]
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {x: find(x) for e in links for x in e if e[0] != e[1] or find(x) != x}
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(x, x) == c for x, c in want.items())
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- licences and quality

def test_licenses(spark, docs, none):
    got = {(r.doc_id, r.text): r for r in licenses.scan(docs).collect()}
    assert got[180, odd_texts()[18]].licences == ["MIT", "proprietary"] and not got[180, odd_texts()[18]].licence_allowed
    assert got[170, odd_texts()[17]].licences == ["CC-BY-NC-4.0"]
    assert got[0, None].licences == [] and got[0, None].licence_allowed
    text = "// Licensed under the Apache License, Version 2.0 (the \"License\");\n// you may not use this file except in compliance with the License."
    df = spark.createDataFrame([(text + "\n# You may obtain a copy of the License at",), (text,)], "text string")
    assert [r.licences for r in licenses.scan(df).collect()] == [["Apache-2.0"]] * 2
    assert licenses.scan(none).count() == 0


def licences_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    return [r.licences for r in licenses.scan(df).orderBy("k").collect()]


def test_licenses_in_padded_lines(spark):
    texts = [" " * 200 + "All rights reserved.", "/" + "*" * 300 + " Released under the MIT License. " + "*" * 300 + "/"]
    assert licences_of(spark, texts) == [["proprietary"], ["MIT"]]


GPL_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""


def test_licenses_in_wrapped_lines(spark):
    wrapped = "This work is licensed under the GNU General{}Public License, version 3."
    headers = [GPL_HEADER] + ["\n".join(f"{mark} {x}" for x in GPL_HEADER.split("\n")) for mark in ("//", " *", "#")]
    df = spark.createDataFrame([(t,) for t in headers], "text string")
    assert [r.licence_sentences for r in licenses.scan(df).collect()] == [["gpl-free", "gpl-hope", "gpl-copy"]] * 4
    assert licences_of(spark, [wrapped.format(x) for x in ("\n", "\r\n", " \n\t// ", "\n\n")]) == [["GPL-3.0"]] * 3 + [[]]
    assert licences_of(spark, ["MIT License\nAll rights\nreserved.\nx", "the MIT License is\none of them"]) == [["MIT", "proprietary"], []]


def test_licenses_of_bodies_and_headers(spark):
    s = licenses.SENTENCES
    agpl, lesser = GPL_HEADER.replace("GNU General", "GNU Affero General"), GPL_HEADER.replace("GNU General", "GNU Lesser General")
    bsd = s["bsd-redistribution"] + "\n\n1. Redistributions of source code must retain the above copyright notice.\n\n"
    want = [(agpl, ["AGPL-3.0"]), (lesser, ["LGPL"]), (GPL_HEADER, ["GPL"]), ("This library is free software; you can redistribute it", ["LGPL"]),
            ("MIT License\n\n" + s["mit-granted"], ["MIT"]), (s["mit-granted"].replace(", ", ",\n"), ["MIT"]), (bsd, ["BSD"]),
            (bsd + s["bsd-3-neither"], ["BSD-3-Clause"]), (s["isc-permission"], ["ISC"]), (s["mpl2-subject"], ["MPL-2.0"]),
            (s["epl2-available"], ["EPL-2.0"]), (s["unlicense"], ["Unlicense"]), ("Licensed under CC BY-ND 3.0.", ["CC-BY-ND-3.0"]),
            ("Licensed under CC BY 3.0.", ["CC-BY-3.0"])]
    assert licences_of(spark, [t for t, _ in want]) == [x for _, x in want]
    df = spark.createDataFrame([(0, "Used under a licence of our own."), (1, "plain words"), (2, s["unlicense"]), (3, None)], "k int, text string")
    assert [r.licence_unclear for r in licenses.scan(df).orderBy("k").collect()] == [True, False, False, False]


def test_quality(spark, docs, none):
    got = quality.judge(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        w, lines = words_of(r.text), [x for x in (r.text or "").split("\n") if words_of(x)]
        seen, cover = defaultdict(list), set()
        for k in range(len(w) - 7):
            seen[tuple(w[k:k + 8])].append(k)
        for at in seen.values():
            cover |= {p + j for p in at for j in range(8)} if len(at) > 1 else set()
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text or "")), len(lines) - len(set(lines)), len(cover))
        assert r.base_failed == (len(w) < 20 or 100 * len(cover) > 30 * len(w))
    assert quality.judge(none).count() == 0


def test_quality_keeps_clean(spark):
    both = quality.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("NOT base_failed")
    clean, junk = (both.filter(f"quality = {q}").agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (1, 0))
    assert clean > 0.99 and junk < 0.3


# ---------------------------------------------------------------- tokens

def test_token_counts(spark, docs, none):
    path = tok.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    want = [(r.doc_id, len((r.text or "").encode()), len(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()]
    got = token_counts.count_tokens(docs, path)
    assert by_row(got.select("doc_id", "n_bytes", "n_tokens").collect()) == by_row(want)
    assert got.filter("over_limit <> (n_tokens > 512)").count() == 0
    assert token_counts.count_tokens(none, path).count() == 0


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tok.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.loaded(tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN)


def test_byte_bpe(spark, docs, none, tik):
    path = tok.path("byte_bpe_50k.tiktoken")
    enc = byte_bpe.decode_documents(byte_bpe.encode_documents(docs, path, tok.PATTERN), path, tok.PATTERN)
    texts = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, tik.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in texts]
    assert by_row((r.doc_id, r.ids, bytes(r.decoded)) for r in enc.select("doc_id", "ids", "decoded").collect()) == by_row(want)
    got = byte_bpe.digests(docs, path, tok.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert by_row(got) == by_row((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha(b)) for i, ids, b in want)
    assert byte_bpe.digests(none, path, tok.PATTERN).count() == 0


def test_prefixes_append_and_edit(bpe, tik):
    rng = random.Random(9)
    for _ in range(60):
        piece = bytes(rng.choices(b"abcdeinthrs", k=rng.randint(1, 40)))
        p = byte_bpe.Prefixes(bpe)
        for c in piece:
            p.append(bytes([c]))
        assert list(p.ids()) == tik.encode_ordinary(piece.decode())
        at = rng.randint(0, len(piece))
        to = rng.randint(at, len(piece))
        p.replace(at, to, b"the")
        assert list(p.ids()) == tik.encode_ordinary(p.piece.decode())


def test_units_of_random_texts(bpe, tik):
    rng = random.Random(4)
    parts = ["a", "b ", "the", " ", "  ", "\n", "\t", "\x01", "\x1c", "é", "漢", "'s", "don't", "!!", "\r\n", "12", "\xa0", " ", "😀", "İ", "é"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(800)]
    n, ids = byte_bpe.encode_texts(pa.array(texts), bpe)
    at = pretokens.starts(n)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [tik.encode_ordinary(t) for t in texts]


# ---------------------------------------------------------------- language

def test_language(spark, docs, none):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(d)
    out = language.predict(d, model)
    right = out.filter(language.held_out(F.col("doc_id"))).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
    for r in language.predict(docs, model).collect():
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert language.predict(none, model).count() == 0
    empty = language.train(none)
    assert {(r.lang_pred, r.score) for r in language.predict(docs, empty).collect()} == {("und", 0.0)}


def test_language_sees_no_held_out_rows(spark):
    rows = [(k, ("ja " if zlib.crc32(str(k).encode()) % 4 == 2 else "no ") * 30, "x" if zlib.crc32(str(k).encode()) % 4 == 2 else "y") for k in range(80)]
    assert language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string")).languages == ["y"]


def test_language_rejects_what_was_not_learned(spark):
    rng = random.Random(3)
    junk = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(60)) for _ in range(20)]
    junk += ["qwrtzpsdfghjklyxcvbnm" * 10, "asdf jkl; " * 40, "Съешь же ещё этих мягких французских булок. " * 5, "快速的棕色狐狸跳过懒狗。" * 9]
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    foreign = d.withColumn("lang", F.when(F.col("lang") != "es", F.col("lang")))
    more = spark.createDataFrame([(-1 - k, t, None, "junk", len(t)) for k, t in enumerate(junk)], d.schema)
    out = corpus_pipeline.language_id(spark, foreign.unionByName(more), SF)
    kept = {r.kind: r.n for r in out.groupBy(F.coalesce("lang", F.when(F.col("source") == "junk", "junk").otherwise("es")).alias("kind"))
            .agg(F.count("*").alias("n")).collect()}
    there = {r.lang: r.n for r in d.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert "junk" not in kept and kept.get("es", 0) <= 0.02 * there["es"]
    assert all(kept[x] >= 0.98 * there[x] for x in ("de", "en", "fr"))


def test_language_without_a_cut_accepts_nothing():
    counts = np.zeros((200, language.BUCKETS), np.float32)
    counts[:, :50] = 1  # equal texts under two languages
    assert language.fit(counts, ["x", "y"] * 100).threshold > 1
    assert language.fit(counts[:0], []).threshold > 1


# ---------------------------------------------------------------- chat

def test_chat_round_trip(spark):
    nasty = ["", None, "</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>\n", "␛0␛1␛", "␛", "a<|", "漢字\n\n", "[IN[INST]ST]"]
    rows = [(k % 4 if k % 5 else None, k // 3, ["user", "assistant", None, "sys<|text|>"][k % 4], nasty[k % len(nasty)], "extra") for k in range(60)]
    rows += [rows[7], rows[7]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, extra string")
    got = {r.conv: r for r in chat.read_back(chat.render(chat.turn_rows(df))).collect()}
    want = defaultdict(list)
    for c, t, r, x, _ in sorted(rows, key=lambda r: (r[1], r[2] or "", r[3] or "")):
        want[c].append((r or "", x or ""))
    assert {k: [tuple(t) for t in r.turns] for k, r in got.items()} == dict(want)
    assert {k: r.loss_text for k, r in got.items()} == {k: "".join(x for r, x in v if r == "assistant") for k, v in want.items()}
    assert chat.render(chat.turn_rows(df.limit(0))).count() == 0


def test_chat_layouts(spark):
    raws = ['{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}',
            '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}],"extra":{"x":1}}',
            '{"prompt":"q","response":"a"}', '{"prompt":"q","completion":"a"}', '{"question":"q","answer":"a","other":3}',
            '{"instruction":"q","output":"a"}']
    bad = ['{"foo":1}', "not json", None, "{}"]
    df = spark.createDataFrame(list(enumerate(raws + bad)), "conv_id long, raw string")
    got = {r.conv: r for r in chat.json_turns(df, "raw").collect()}
    for k in range(len(raws)):
        assert [tuple(t) for t in got[k].turns] == [("user", "q"), ("assistant", "a")]
    assert all(got[len(raws) + k].turns is None and got[len(raws) + k].layout is None for k in range(len(bad)))
    assert chat.render(chat.explode_turns(chat.json_turns(df, "raw"))).count() == len(raws)
    typed = spark.createDataFrame([(1, [("user", "q"), ("assistant", "a")])], "conv_id long, messages array<struct<role:string,content:string>>")
    assert [(r.role, r.text) for r in chat.turn_rows(typed).orderBy("turn").collect()] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        chat.turn_rows(spark.createDataFrame([(1, "x")], "conv_id long, foo string"))


def test_chat_is_native(spark):
    plan = chat.op9_chat_format(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- embeddings

def links_by_force(rows, least=0.93):
    def usable(v, label):
        return v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    ids = [r[0] for r in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            (_, v, x), (_, w, y) = rows[a], rows[b]
            if x == y and usable(v, x) and usable(w, y) and len(v) == len(w):
                v, w = (np.array(z, np.float32).astype(float) for z in (v, w))
                if v @ w / np.sqrt((v @ v) * (w @ w)) >= least:
                    n[a] += 1
                    n[b] += 1
                    s, t = find(a), find(b)
                    root[max(s, t)] = min(s, t)
    least_id = defaultdict(lambda: 1 << 62)
    for k, i in enumerate(ids):
        least_id[find(k)] = min(i, least_id[find(k)])
    return by_row((i, n[k], least_id[find(k)], least_id[find(k)] == i) for k, i in enumerate(ids))


@pytest.mark.parametrize("block", [1024, 8])
def test_embedding_dedup(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(6)
    rows = []
    for k in range(12):
        base = rng.normal(size=64)
        rows += [(len(rows) + j, (base + rng.normal(size=64) * 0.22 * (j > 2)).tolist(), int(k % 2)) for j in range(12)]
    odd = [None, [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] * 64, [], [1.0] * 3, [1.0, 1.0, 1.1], rows[0][1]]
    rows += [(1000 + k, v, None if k == len(odd) - 1 else 0) for k, v in enumerate(odd)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, links string")
    assert by_row(embedding_dedup.near_duplicates(df).collect()) == links_by_force(rows)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_recall():
    """Codes of two axes, on pairs near the threshold."""
    rng = np.random.default_rng(8)
    x = embedding_dedup.unit(rng.normal(size=(400, 64)))
    y = embedding_dedup.unit(x + rng.normal(size=x.shape) * 0.047)
    near = (x * y).sum(1) >= 0.93
    a, b = (embedding_dedup.codes(z, 12, 2) for z in (x, y))
    meet = ((a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)).any(1)
    assert near.sum() > 100 and meet[near].mean() > 0.99


# ---------------------------------------------------------------- pipeline

def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        now = {r.doc_id for r in out.select("doc_id").collect()}
        assert now <= ids
        if name == "MinHash near-dedup":
            rows = groups([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
            assert now == {r[0] for r in rows if r[3]}
        if name == "substring dedup":
            force = {r[0]: r for r in repeats([(r.doc_id, r.text) for r in docs.collect()])}
            for r in out.collect():
                if force[r.doc_id][2]:
                    assert hashlib.sha256(r.text.encode()).hexdigest() == force[r.doc_id][3] and r.n_chars == len(r.text)
        docs, ids = spark.createDataFrame(out.collect(), out.schema), now
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == ids
    assert corpus_pipeline.run(spark, SF).count() == pieces.count()


def clashing(docs):
    """Columns named like what the operators compute, with values that must not change."""
    return docs.withColumns({"n_words": F.lit(777), "kept": F.lit("mine"), "score": F.lit(-1.5), "n_removed": F.lit(9), "lang_pred": F.lit("xx"),
                             "component_id": F.lit(3), "h": F.lit(1), "quality": F.lit(4), "__words": F.lit("w")})


def test_pipeline_keeps_the_callers_columns(spark):
    docs = clashing(spark.read.parquet(f"{SF}/documents.parquet"))
    docs = docs.union(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")))  # null ids
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all((r.n_words, r.kept, r.score, r.n_removed, r.lang_pred, r.component_id, r.h, r.quality, r["__words"]) ==
                            (777, "mine", -1.5, 9, "xx", 3, 1, 4, "w") for r in rows), name
        docs = spark.createDataFrame(rows, out.schema)
    assert any(r.doc_id is None for r in rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_quality_filter_does_not_split_again(spark):
    """A filter on a measure must not paste the splitting of texts into itself."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def splits(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("split(")

    base = splits(quality.judge(docs))
    for df in (quality.passing(docs), quality.judge(docs).filter("kept"), quality.judge(docs).filter("n_repeat_words > 3 AND stop_ratio > 0.1")):
        assert splits(df) <= base


@pytest.mark.parametrize("count", [1, 7, 100, 5000])
def test_least_hashed(spark, count):
    from tickframe.llm import common
    df = spark.range(3000).select("id", (F.col("id") % 10 == 3).cast("int").alias("g"), F.xxhash64("id").alias("h")).repartition(3)
    df = df.union(spark.createDataFrame([(9001, 1, 5), (9000, 1, 5)], "id long, g int, h long"))  # equal hashes
    got = sorted((r.g, r.h, r.id) for r in common.least_hashed(df, "g", count).collect())
    every = sorted((r.g, r.h, r.id) for r in df.collect())
    assert got == [x for g in (0, 1) for x in [e for e in every if e[0] == g][:count]]


def test_copies_of_a_licence_side_by_side(spark):
    """Two and three notices in a row give what one gives, for every rule."""
    def notice(rule):
        return "\n".join(licenses.SENTENCES[x] for x in rule.sentences)
    rules = licenses.RULES
    one = licences_of(spark, [notice(r) for r in rules])
    for copies in (2, 3):
        assert licences_of(spark, ["\n".join([notice(r)] * copies) for r in rules]) == one
        assert licences_of(spark, ["\n\n".join([notice(r)] * copies) for r in rules]) == one


def test_identifier_lines_and_unclear_texts(spark):
    rows = ["/* SPDX-License-Identifier: GPL-3.0-only */", "# SPDX-License-Identifier: MIT", "This project has a licence of its own.", "no such words", None]
    got = licenses.scan(spark.createDataFrame(list(enumerate(rows)), "k int, text string")).orderBy("k").collect()
    assert [(list(r.licences), r.licence_allowed, r.licence_unclear) for r in got] == [
        (["GPL-3.0"], False, False), (["MIT"], True, False), ([], False, True), ([], True, False), ([], True, False)]


def test_licence_sql_over_bodies(spark, tmp_path):
    """The registered SQL has the whole table: it agrees on bodies, wrapped lines and copies."""
    s, texts = list(licenses.SENTENCES.values()), []
    rng = random.Random(8)
    for _ in range(300):
        parts = [rng.choice(s) for _ in range(rng.randint(0, 5))] + rng.sample(["Some words.", "All of it is licensed.", "", "no licence words; none"], 2)
        rng.shuffle(parts)
        t = rng.choice(["\n", "\n\n", " ", "\n * "]).join(parts)
        texts.append(t.replace(" the ", rng.choice([" the ", "\nthe ", " the\n# "])))
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None, ""])], "doc_id long, text string")
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = by_row(licenses.op4_license_scan(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == by_row(con.execute(licenses.SQL).fetchall())
    assert len({r[3] for r in got}) > 20


def test_chat_layouts_with_clashing_fields(spark):
    df = spark.createDataFrame([(1, "q", "a", "noise", "x")], "conv_id long, question string, answer string, prompt string, role string")
    assert [(r.role, r.text) for r in chat.turn_rows(df).orderBy("turn").collect()] == [("user", "q"), ("assistant", "a")]
    df = df.withColumn("system", F.lit("s"))  # a more specific layout now fits
    assert [r.role for r in chat.turn_rows(df).orderBy("turn").collect()] == ["system", "user", "assistant"]
    with pytest.raises(ValueError):
        chat.turn_rows(spark.createDataFrame([(1, "x")], "conv_id long, note string"))
    rows = ['{"messages":[{"role":"user","content":null},{"role":"assistant","content":"b"}],"prompt":"extra"}',
            '{"question":"q","answer":"a","system":"s","input":"z"}', '{"prompt":"p","response":"r","system":"ignored"}', '{"prompt":"p"}', "no json", None]
    got = {r.conv: (r.layout, r.turns) for r in chat.json_turns(spark.createDataFrame(list(enumerate(rows)), "conv_id long, raw string"), "raw").collect()}
    assert got[0][0] == "messages" and [(t.role, t.text) for t in got[0][1]] == [("user", None), ("assistant", "b")]
    assert got[1][0] == "system question" and got[2][0] == "prompt"
    assert all(got[k] == (None, None) for k in (3, 4, 5))
