"""The registered queries against plain versions, on whole small tables."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import queries

from . import brute

SF = "/root/testdata/sf0.01"


def table(name, columns):
    return duckdb.sql(f"select {columns} from '{SF}/{name}.parquet'").fetchall()


def rows(spark, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, SF).collect()]


def test_bpe(spark):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in rows(spark, "op1_bpe")}
    for i, text in table("documents", "doc_id, text"):
        ids = coder.encode(text or "", add_special_tokens=False).ids
        r = got.pop(i)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), brute.sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == brute.sha(coder.decode(ids, skip_special_tokens=False))
    assert not got


def test_vectors(spark):
    data = table("embeddings", "vec_id, embedding")
    ids, x = np.array([r[0] for r in data]), np.array([r[1] for r in data], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    comp = brute.components(ids.tolist(), [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(near))])
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows(spark, "op2_vectors")}
    assert got == {int(i): (int(n), comp[int(i)], comp[int(i)] == int(i)) for i, n in zip(ids, near.sum(1))}


def test_minhash(spark):
    want = brute.near_texts(table("documents", "doc_id, text"), 3, 85, 100)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows(spark, "op3_minhash")}
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_langid(spark):
    got = rows(spark, "op5_langid")
    truth = dict(table("documents", "doc_id, lang"))
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    out = [r for r in got if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) >= 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_licences(spark):
    got = {r["doc_id"]: r["family"] for r in rows(spark, "op6_licences") if r["confirmed"]}
    lines = {"MIT License": "mit", "Apache License": "apache-2.0", "General Public License, version 3": "gpl-3.0", "CC BY-NC": "cc-by-nc"}
    for i, text in table("documents", "doc_id, text"):
        for words, family in lines.items():
            if words in (text or ""):
                assert got[i] == family


def test_packing(spark):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = rows(spark, "op7_packing")
    pieces = {(r["doc_id"], r["piece"]): r for r in got}
    total = 0
    for i, text in table("documents", "doc_id, text"):
        ids = coder.encode(text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for k, at in enumerate(range(0, len(ids), 2048)):
            r = pieces.pop((i, k))
            part = ids[at : at + 2048]
            assert (r["start"], r["length"], r["ids_crc32"]) == (at, len(part), brute.crc_of(part))
    assert not pieces
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(bins) <= -(-total // 2048) + 1


def test_topk(spark):
    data = table("embeddings", "vec_id, embedding")
    x = np.array([[int(np.floor(1024 * float(v))) for v in r[1]] for r in data])
    ids = np.array([r[0] for r in data])
    want = []
    for i, q in zip(ids, x):
        if i % 100 == 0:
            best = sorted((-int(s), int(j)) for s, j in zip(x @ q, ids) if j != i)[:10]
            want += [(int(i), k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows(spark, "op8_topk")) == sorted(want)


def test_secrets(spark):
    got = {r["doc_id"]: r for r in rows(spark, "op9_secrets")}
    for i, text in table("documents", "doc_id, text"):
        spans = brute.base_spans(text or "")
        r = got.pop(i)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[3] == k for s in spans) for k in ("assign", "access", "hex"))
        line = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert r["base_sha256"] == brute.sha(line)
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))
    assert not got


def test_chat(spark):
    data = table("conversations", "conv_id, turn, role, text") + [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    convs = {}
    for c, t, r, x in sorted(data):
        convs.setdefault(c, []).append((r, x or ""))
    got = {r["conv_id"]: r for r in rows(spark, "op10_chat")}
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), brute.sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), brute.sha(loss))


@pytest.mark.parametrize("name", ["op4_urls"])
def test_urls(spark, name):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
    got = {r["page_id"]: r for r in rows(spark, name)}
    for i, url in table("pages", "page_id, url"):
        rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
        host = rest.split("/")[0].split("?")[0].split("#")[0]
        path = rest[len(host) :].split("?")[0].split("#")[0]
        host = host.lower()
        fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        r = got[i]
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"]) == (max(fit)[1:] if fit else (None, "allow"))
