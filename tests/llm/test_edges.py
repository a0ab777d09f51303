"""Nulls, empty and repeated rows, empty tables and clashing names for every operator."""

import functools

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import bpe, chat, components, langid, licenses, minhash, packing, secrets, topk, urls, vectors

from . import brute

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ROWS = [
    (1, "one two three four five six", "en", None, 1),
    (1, "one two three four five six", "en", None, 1),
    (2, "ONE  two three\tfour five six", None, "s", None),
    (3, None, "en", "s", 0),
    (4, "", "fr", "s", 0),
    (5, "12 34 !!", "fr", "s", 3),
    (None, "one two three four five six", "fr", "s", 3),
    (6, "x" * 5000 + " y" * 9000, "fr", "s", 3),
]
EMPTY = []


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).withColumns({n: F.lit("own") for n in ("ids", "lang_pred", "component_id", "base", "member", "kept")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame(EMPTY, DOCS)


def test_bpe_edges(spark, docs, none):
    coder = bpe.Bpe(spark, public_tokenizers.path("byte_bpe_50k.json"))
    got = coder.tokenized(docs.select("doc_id", "text", "kept", "ids"), decoded="decoded").collect()
    assert len(got) == len(ROWS) and sorted(r["decoded"] for r in got) == sorted(r[1] or "" for r in ROWS)
    assert coder.tokenized(none).count() == 0
    col = docs.select("text", coder.decode(coder.encode("text")).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "") for r in col)


@functools.cache
def coders():
    byte, word = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    return bpe.ForcedBoundaryBPE(open(byte).read()), Tokenizer.from_file(byte), packing.WordTokenizer(open(word).read()), Tokenizer.from_file(word)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aAeé '’\n\t\u00a0\u3000.!'s1½中\u0301<|endoftext|>lrvtd")), max_size=40))
def test_forced_boundaries_change_nothing(text):
    own = coders()
    ids = own[0].encode(pa.array([text, None, text], pa.string())).to_pylist()
    assert ids == [own[1].encode(text, add_special_tokens=False).ids, [], ids[0]]
    assert np.frombuffer(own[2].ids([text.encode()])[0], "<u4").tolist() == own[3].encode(text, add_special_tokens=False).ids


def test_minhash_edges(docs, none):
    got = minhash.near_duplicates(docs, shingle=3).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[1] == [(4, 1, True)] * 2 and by[2] == [(4, 1, False)]
    assert by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)] and by[5] == [(1, 5, True)] and by[None] == [(4, None, True)]
    assert minhash.near_duplicates(none).count() == 0


def test_minhash_near_groups(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        own = list(base)
        for k in rng.integers(0, 60, size=int(rng.integers(0, 4))):
            own[k] = f"v{rng.integers(0, 5)}"
        rows.append((i, " ".join(own)))
    want = brute.near_texts(rows, 3, 85, 100)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle=3, numerator=85, block=16).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_vectors_edges(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.25 * rng.standard_normal(16)).tolist(), 1) for i in range(80)] + [(i, rng.standard_normal(16).tolist(), 2) for i in range(100, 140)]
    rows += [(200, rows[0][1], 1), (201, [2 * v for v in rows[0][1]], 1)]
    odd = [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] + [1.0] * 15, 1), (304, [], 1), (305, [float("inf")] * 16, 1), (None, rows[0][1], 1), (306, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, kept int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(df, block=16).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    ids = [r[0] for r in rows]
    comp = brute.components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))])
    for k, i in enumerate(ids):
        assert got[i] == (int(near[k].sum()), comp[i], comp[i] == i)
    assert all(got[i] == (0, i, True) for i in range(300, 307)) and got[None] == (0, None, True)
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_loose_cosine_misses_nothing(spark):
    assert vectors.table_count(64, 0.3, 3, 4) > vectors.MOST_TABLES
    h, tables = vectors.plan(64, 0.3, 3, 4)
    assert tables <= vectors.MOST_TABLES and (h, tables) == ((h, vectors.table_count(64, 0.3, h, 4)) if h else (0, 1))
    x = np.random.default_rng(6).standard_normal((60, 24))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.1
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    assert {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(df, cosine=0.1, probes=2, block=16).collect()} == dict(enumerate(near.sum(1).tolist()))


def test_urls_edges(spark):
    link = '<head><link rel="canonical" href="{}"></head>'
    rows = [
        (1, "http://a.org/x", link.format("http://b.net/es/y")), (2, "http://b.net/es/y", None), (3, "http://c.org/", '<meta http-equiv="refresh" content="0; url=http://a.org/x">'),
        (4, "http://d.org/", link.format("http://b.net/es/z")), (5, "http://e.org/", link.format("http://d.org/")), (6, "http://e.org/", link.format("http://z.com/ok")), (7, None, "x"), (8, "no url", None), (9, "HTTP://M.COM?q", ""),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("verdict", F.lit("x"))
    rules = [("com", "/", "allow"), ("com", "", "allow"), ("net", "/es/", "block")]
    got = {r["page_id"]: (r["rule"], r["verdict"], r["decided_by"]) for r in urls.judge_urls(df, rules).collect()}
    assert got[1] == (None, "block", "alias") and got[2] == ("net/es/", "block", "rule") and got[3] == (None, "block", "alias")
    assert got[4] == got[5] == got[6] == (None, "allow", "alias")
    assert got[7] == got[8] == (None, "allow", "default") and got[9] == ("com", "allow", "rule")
    assert urls.judge_urls(df.limit(0), rules).count() == 0


def test_urls_resolved_links(spark):
    link, refresh = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="{}">'
    heads = [
        link.format("next.html"), link.format("../x"), link.format("?id=3"), refresh.format("0; url='http://bad.net/q'"), "<meta content='5;URL=\"http://bad.net/q\"' http-equiv=Refresh>", refresh.format("0; url=../x"),
        link.format("http://m.org/") + link.format("http://bad.net/q"), refresh.format("9; url=http://m.org/") + refresh.format("0; url=http://bad.net/q"), link.format("http://bad.net/a?b=1&amp;c=2"), link.format("http://bad.net"),
        '<base href="http://bad.net/d/">' + link.format("e.html"), link.format("http://bad.net/z/../q"), link.format("go?to=http://m.org/"),
    ]
    bad = ["http://p0.org/a/next.html", "http://p1.org/x", "http://p2.org/a/b?id=3", "http://bad.net/q", "http://bad.net/a?b=1&c=2", "http://bad.net/", "http://bad.net/d/e.html", "http://p5.org/x", "http://p12.org/a/go?to=http://m.org/"]
    rows = [(i, f"http://p{i}.org/a/b", h) for i, h in enumerate(heads)] + [(50, "http://p50.org/a/b", link.format("mailto:x@y.z")), (51, "http://p51.org/a/b", link.format("http://[x/"))]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    rules = [(b.split("://")[1].split("/")[0], "/" + b.split("/", 3)[3].split("?")[0], "block") for b in bad]
    got = {r["page_id"]: (r["verdict"], r["decided_by"]) for r in urls.judge_urls(df, [r for r in rules if r[:2] != ("p2.org", "/a/b")]).collect()}
    want = {i: ("block", "alias") for i in range(len(heads))} | {2: ("allow", "default"), 50: ("allow", "default"), 51: ("allow", "default")}
    assert got == want
    links = {(r["u"], r["v"]) for r in urls.page_links(df).collect()}
    assert ("p2.org/a/b", "p2.org/a/b?id=3") in links and ("p8.org/a/b", "bad.net/a?b=1&c=2") in links and ("p6.org/a/b", "m.org/") in links
    assert urls.judge_urls(df.limit(1), [], df.limit(1).selectExpr("'http://h' as u", "url as v")).count() == 1
    assert df.limit(1).select(urls.address(F.lit("http://h")), urls.address(F.lit("HTTP://H/"))).first()[:] == ("h/", "h/")


def test_language_edges(docs, none):
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.language_id(docs).collect()}
    assert got[3] == got[4] == got[5] == ("und", 0.0) and got[1][0] in ("en", "fr")
    assert langid.language_id(none).count() == 0
    assert {r["lang_pred"] for r in langid.language_id(docs, none).collect()} == {"und"}


def test_licence_edges(spark, docs, none):
    rows = [(1, "Text.\nReleased under the MIT License.\nMore"), (2, "He lost a fishing license."), (3, None), (None, "Licensed under CC BY-NC 4.0."), (4, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("family", F.lit("x"))
    got = sorted(((r["doc_id"] or 0, r["family"], r["start"], r["end"], r["confirmed"]) for r in licenses.scan_licences(df).collect()))
    assert got == [(0, "cc-by-nc", 0, 28, True), (1, "mit", 6, 37, True)]
    assert licenses.scan_licences(none).count() == 0


def test_licences_over_lines(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version {} of the License, or\n# (at your option) any later version.\n#\n# It has no warranty."
    words = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    rows = [
        (1, bsd), (2, gpl.format(3)), (3, gpl.format(2)), (4, "Released under the GPLv3."), (5, "Released under the GPLv2."), (6, "dnl " + words.replace(" ", "\ndnl ")), (7, "The end.\nReleased under the MIT\n\nLicense. Not here"),
        (8, "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: Apache-2.0\nAll rights reserved."), (9, "Released under the LGPLv3."),
    ]
    got = {}
    for r in licenses.scan_licences(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        if r["confirmed"]:
            got.setdefault(r["doc_id"], []).append((r["start"], r["end"], r["family"]))
    assert got[1] == [(0, len(bsd), "bsd")] and got[6] == [(0, len(rows[5][1]), "mit")]
    assert [f for *_, f in got[2]] == ["gpl-3.0"] and [f for *_, f in got[3]] == ["gpl-2.0"]
    assert [got[i][0][2] for i in (4, 5, 9)] == ["gpl-3.0", "gpl-2.0", "lgpl"]
    assert sorted(got[8]) == [(0, 28, "mit"), (29, 64, "apache-2.0"), (65, 85, "proprietary")]
    assert all(end <= 31 for _, end, _ in got.get(7, []))


def test_packing_edges(docs, none):
    got = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True, capacity=64).collect()
    assert sum(r["piece"] == 0 for r in got) == len(ROWS)
    assert all(r["length"] == len(r["ids"]) for r in got)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in own) <= 64 and sorted(own)[0][0] == 0 for own in bins.values())
    assert packing.pack(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 200), min_size=1))
def test_plan_places_every_piece_once(counts):
    plan = packing.plan_places(counts, 50)
    length = np.concatenate([np.full(c, n) for n, c in sorted(counts.items())])
    rank = np.concatenate([np.arange(c) for _, c in sorted(counts.items())])
    sequence, offset = packing.place(plan, length, rank)
    order = np.lexsort((offset, sequence))
    ends = {}
    for s, o, n in zip(sequence[order], offset[order], length[order]):
        assert ends.get(s, 0) == o
        ends[s] = o + n
    assert max(ends.values()) <= 50


def test_topk_edges(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(0, 30)] + [(40, None), (41, [None, 1.0]), (42, [float("nan"), 1.0]), (43, []), (None, [9.0, 9.0]), (44, [1.0]), (100, [1e30, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit(0))
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 3, tree_rows=8, pilot=4).where("query_id = 0").orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 1 << 20), (2, 2, 1 << 20), (3, 3, 1 << 20)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_secret_edges(spark, docs, none):
    pad = "z" * 600
    rows = [
        (1, "secret=token:abcdefgh"), (2, "é token = 'abcdef1' AKIA" + "A" * 16), (3, "user: bob\npwd=hunter22x"), (4, "pwd=hunter22x " + pad), (5, "user: bob " + pad + " pwd=hunter22x"),
        (6, "https://db.example.com/x user=bob password=swordfish"), (7, None), (8, ""), (9, " ".join(f"token=abcdef{i}" for i in range(700))),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("secrets", F.lit("x"))
    got = {r["doc_id"]: r for r in secrets.scan_secrets(df).withColumns({"line": secrets.span_text("secrets"), "red": secrets.redact(F.col("text"), F.col("secrets"))}).collect()}
    for i, text in rows:
        assert [(s["start"], s["order"], s["end"], s["kind"]) for s in got[i]["base"]] == brute.base_spans(text or "")
    assert got[1]["line"] == "" and got[4]["line"] == got[5]["line"] == ""
    assert got[3]["line"] == "ident:0:9,weak:10:23" and got[3]["red"] == "[REDACTED]\n[REDACTED]"
    assert got[6]["line"].startswith("endpoint:0:24,ident:25:33,assign:34:")
    assert secrets.scan_secrets(none).count() == 0 and secrets.scan_secrets(docs).count() == len(ROWS)


def test_secrets_linked_by_covered_parts(spark):
    digits = "0123456789abcdef01234567"
    rows = [(1, f"client_id: {digits}\npwd: hunter22x"), (2, f"client_id: {digits}"), (3, f"client_id: {digits} " + "z" * 600 + " pwd: hunter22x"), (4, f"http://a.net/{digits}\nuser: bob\npwd: hunter22x")]
    found = secrets.scan_secrets(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r["doc_id"]: (r["line"], r["red"]) for r in found.select("doc_id", secrets.span_text("secrets").alias("line"), secrets.redact(F.col("text"), F.col("secrets")).alias("red")).collect()}
    assert got[1] == ("hex:11:35,weak:36:50", "client_id: [REDACTED]\n[REDACTED]")
    assert got[2][0] == "hex:11:35" and got[3][0] == "hex:11:35"
    assert got[4][0] == "hex:13:37,ident:38:47,weak:48:62"


def test_chat_edges(spark):
    odd = "\\</turn>\n<turn x> \\\\ <turn <|endoftext|> \u00e9\u4e2d"
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", odd), (2, 0, "user", "a"), (2, 1, "assistant", odd), (3, 0, "user", "a"), (3, 1, "assistant", None), (None, 0, None, "b"), (4, 1, "x>y", odd), (4, 1, "x>y", odd), (5, 0, "user", "z" * 500)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("path_key", F.lit(1))
    coder = bpe.Bpe(spark, public_tokenizers.path("byte_bpe_50k.json"))
    packs, members = chat.prefix_packs(df, coder, pack_chars=200)
    got = {r["conv_id"]: r for r in members.join(chat.read_packs(packs, coder), "path_key").collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("user", "a"), ("assistant", odd)] and got[1]["loss"] == odd
    assert got[3]["loss"] == "" and [t["role"] for t in got[None]["turns"]] == [""] and len(got[4]["turns"]) == 2 and got[2]["path_key"] == got[1]["path_key"]
    assert got[5]["turns"][0]["text"] == "z" * 500
    assert chat.prefix_packs(df.limit(0), coder)[0].count() == 0


def test_chat_tree_in_tokens(spark):
    """Shared turns' tokens once, positions and attention intervals against the plain encoding of each conversation."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    ids_of = lambda turns: [i for t in turns for part in chat.turn_parts(*t) for i in plain.encode(part, add_special_tokens=False).ids]
    convs = [[("user", f"q{a}"), ("assistant", "<|endoftext|> yes")] + [("user", f"then {b}"), ("assistant", f"so {a} {b}")] * (b > 0) for a in range(3) for b in range(3)]
    rows = [(c, i, r, t) for c, turns in enumerate(convs) for i, (r, t) in enumerate(turns)]
    coder = bpe.Bpe(spark, public_tokenizers.path("byte_bpe_50k.json"))
    packs, members = chat.prefix_packs(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(1), coder)
    keys = {r["path_key"]: convs[r["conv_id"]] for r in members.collect()}
    seen, written = set(), 0
    for pack in packs.collect():
        assert 50256 not in pack["ids"]
        written += len(pack["ids"])
        for leaf in pack["leaves"]:
            node = pack["nodes"][leaf["node"]]
            spans = [(s["start"], s["end"]) for s in node["ancestors"]] + [(node["start"], node["start"] + node["length"])]
            assert [i for s, e in spans for i in pack["ids"][s:e]] == ids_of(keys[leaf["path_key"]])
            assert node["position"] == sum(e - s for s, e in spans[:-1])
            seen.add(leaf["path_key"])
    assert seen == set(keys)
    distinct = {tuple(turns[: k + 1]) for turns in convs for k in range(len(turns))}
    once = sum(len(ids_of(path[-1:])) for path in distinct)
    assert once <= written < sum(len(ids_of(t)) for t in convs)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="a\\<>/turn \n", max_size=12), st.text(alphabet="a\\<>/turn \n", max_size=30)), max_size=4))
def test_turns_round_trip(turns):
    assert chat.parse("".join("".join(chat.turn_parts(*t)) for t in turns)) == turns


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, size=(150, 2))] + [(i, i + 1) for i in range(300, 340)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame([*edges, (1, None), (7, 7)], "u bigint, v bigint")).collect()}
    want = brute.components({x for e in edges if e[0] != e[1] for x in e}, edges)
    assert got == want


def test_pipeline(spark, docs, none):
    got = docs.select(*corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, got, "")
        assert got.columns == list(corpus_pipeline.COLUMNS)
    kept = sorted((r["doc_id"] is None, r["doc_id"]) for r in got.collect())
    assert kept[0][1] == 1 and len(kept) == 4
    assert corpus_pipeline.STAGES[-1][1](spark, got, "").count() >= 4
    empty = none
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
    assert empty.count() == 0
