"""Operators that SQL cannot express against plain versions, on random and small whole tables."""

import collections
import math
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import langid, licenses, minhash, secrets, topk, urls, vectors

from . import brute

SMALL = "/root/testdata/sf0.001"


def documents(columns="doc_id, text, lang"):
    return duckdb.sql(f"select {columns} from '{SMALL}/documents.parquet' order by doc_id").fetchall()


# -- urls ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_aliases_of_random_graphs(spark, seed):
    """Redirects and canonical links of a random graph: decisions of components by union-find."""
    rng = random.Random(seed)
    hosts = ["a.org", "b.org", "c.net", "bad.io", "good.io", "d.bad.io"]
    addresses = [f"{rng.choice(hosts)}/p{k}" for k in range(120)]
    links = [(rng.choice(addresses), rng.choice(addresses)) for _ in range(70)]
    rules = [("bad.io", "/", "block"), ("good.io", "/", "allow"), ("a.org", "/p1", "block")]
    out = collections.defaultdict(list)
    for u, v in links:
        out[u].append(v)
    tag = lambda v, k: f'<link rel="canonical" href="http://{v}">' if k % 2 else f"<meta http-equiv=refresh content='0; url=https://{v}#x'>"
    pages = [(k, f"http://{a}", "<p>x</p>" + "".join(tag(v, j) for j, v in enumerate(out[a]))) for k, a in enumerate(addresses)]
    pages += [(1000 + k, f"https://{a}#y", None) for k, a in enumerate(addresses[:20])]

    def ruled(a):
        host, path = a.split("/", 1)[0], "/" + a.split("/", 1)[1]
        fit = [(len(h + p), v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[1] if fit else None

    comp = brute.components(sorted(set(addresses)), [tuple(sorted(x)) for x in links])
    members = collections.defaultdict(set)
    for a, c in comp.items():
        members[c].add(ruled(a))

    def verdict(a):
        if ruled(a):
            return ruled(a), "rule"
        linked = members[comp[a]] if any(a in x and x[0] != x[1] for x in links) else set()
        return next(((v, "alias") for v in ("allow", "block") if v in linked), ("allow", "default"))

    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["page_id"]: (r["verdict"], r["decided_by"]) for r in urls.judge_urls(df, rules).collect()}
    want = {k: verdict(u.split("://")[1].split("#")[0]) for k, u, _ in pages}
    assert got == want
    assert {"alias"} <= {w for _, w in want.values()} and any(v == ("block", "alias") for v in want.values())


# -- language -----------------------------------------------------------------------------------

_MULTIPLIERS = (2654435761, 2246822519, 3266489917)


def buckets_of(text, size):
    """The buckets of all one- to three-character grams, with whole numbers and a dictionary."""
    points, found = [ord(c) for c in text.lower()], collections.Counter()
    for n in (1, 2, 3):
        for at in range(len(points) - n + 1):
            h = n * 0x9E3779B1 % 2**32
            for k in range(n):
                h ^= points[at + k] * _MULTIPLIERS[k] % 2**32
                h = (h << 13 | h >> 19) % 2**32 * 0x85EBCA6B % 2**32
            found[(h >> 15) % size] += 1
    return found


def test_language_scores(spark):
    """An independent naive Bayes: dictionaries of counts, logarithms summed gram by gram."""
    rows = documents()
    train = [(t, g) for i, t, g in rows if t is not None and g is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    size = langid.BUCKETS
    counts, docs = collections.defaultdict(collections.Counter), collections.Counter(g for _, g in train)
    grams = {t: buckets_of(t, size) for t in {t for _, t, _ in rows if t is not None}}
    for t, g in train:
        counts[g] += grams[t]
    totals = {g: sum(c.values()) + langid.SMOOTHING * size for g, c in counts.items()}
    want = {}
    for i, t, _ in rows:
        if t is None or not any(map(str.isalpha, t)):
            want[i] = ("und", 0.0)
            continue
        z = {g: math.log(docs[g] / len(train)) + sum(n * (math.log(counts[g][b] + langid.SMOOTHING) - math.log(totals[g])) for b, n in grams[t].items()) for g in docs}
        best = min(z, key=lambda g: (-z[g], g))
        want[i] = (best, 1 / sum(math.exp(v - z[best]) for v in z.values()))
    docs_df = spark.read.parquet(f"{SMALL}/documents.parquet")
    learned = docs_df.where(~langid.held_out("doc_id"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.language_id(docs_df, learned).collect()}
    assert {i: g for i, (g, _) in got.items()} == {i: g for i, (g, _) in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 1e-6 for i in want)


def test_language_ties(spark):
    train = spark.createDataFrame([("abc abc", "xx"), ("abc abc", "aa")], "text string, lang string")
    asked = spark.createDataFrame([("abc",), ("abc",), ("b" * 3_000_000,)], "text string")
    assert [(r["lang_pred"], round(r["score"], 9)) for r in langid.language_id(asked, train).collect()] == [("aa", 0.5)] * 3


# -- licences -----------------------------------------------------------------------------------


def test_licence_scores(spark):
    """Every reported notice has the family and probability that the model gives its text."""
    model = licenses.fit()
    texts = dict(documents("doc_id, text"))
    found = licenses.scan_licences(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert found
    for r in found:
        family, probability = model.classify(texts[r["doc_id"]][r["start"] : r["end"]].replace("\n", " "))
        assert (family, round(probability, 6)) == (r["family"], round(r["probability"], 6))


def test_licence_words_in_other_uses(spark):
    """Sentences that speak of licences without being notices: none is confirmed."""
    other = (
        "Please read our license before you use this software version.", "His license plate was found in the public garden.", "The Apache nation signed the treaty in 1852.",
        "MIT students built the software over a weekend.", "The foundation reserved all rooms for members of the public.", "Creative people met in the commons to discuss attribution.",
        "Version 3 of the general plan is open for public comment.", "The museum holds the copyright office's oldest records.", "A permission slip is needed for the visit, free of charge.",
        "Two conditions are met: the source is clean and the redistribution of water is fair.",
    )
    df = spark.createDataFrame(list(enumerate(other)), "doc_id bigint, text string")
    assert [r["doc_id"] for r in licenses.scan_licences(df).where("confirmed").collect()] == []


# -- near-duplicates ----------------------------------------------------------------------------


@pytest.mark.parametrize("hashes", [2, 3])
def test_vector_recall(hashes):
    """Pairs at the threshold itself, with the tables that the plan takes: none of 3,000 is missed
    by all of them (1e-5 each is promised)."""
    rng = np.random.default_rng(3)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.9 * a + math.sqrt(1 - 0.81) * b
    h, tables = vectors.plan(64, 0.9, hashes, vectors.PROBES)
    assert h == hashes
    ca, cb = (vectors.bucket_codes(x, tables, h, vectors.PROBES) for x in (a, b))
    met = (ca[:, :, :, None] == cb[:, :, None, :]).any(axis=(1, 2, 3))
    assert (~met).sum() <= 1


def test_vector_groups_of_all_sizes(spark):
    """Groups of 2 to 150 near vectors, in blocks of 16: links and components by brute force."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.standard_normal((1, 24)) + 0.16 * rng.standard_normal((m, 24)) for m in (2, 3, 9, 30, 45, 60, 70, 150)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    comp = brute.components(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(near))])
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(df, block=16).collect()}
    assert got == {i: (int(near[i].sum()), comp[i]) for i in range(len(x))}


def test_register_recall_and_union():
    """Pairs of sets of similarity 0.85 share a band; registers of a union are merged registers."""
    rng = np.random.default_rng(5)
    rows = minhash.band_rows(0.85)
    missed = 0
    for _ in range(300):
        both = rng.integers(0, 2**63, size=850, dtype=np.uint64)
        one, two = (np.concatenate([both, rng.integers(0, 2**63, size=75, dtype=np.uint64)]) for _ in range(2))
        ra, rb = (minhash.registers(minhash.least(x)) for x in (one, two))
        union = minhash.registers(minhash.least(np.unique(np.concatenate([one, two]))))
        assert (minhash.merge_registers(ra, rb) == union).all()
        estimate = minhash.joint_estimate(ra, rb[None], len(one), np.array([len(two)]))[0]
        assert abs(estimate - 0.85) < 0.13
        ka, kb = (minhash.band_keys(r[None], rows)[0] for r in (ra, rb))
        missed += not (ka == kb).any()
    assert missed == 0


def test_repeated_and_long_texts(spark, monkeypatch):
    """Blocks of few bytes: the same classes as by brute force."""
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 4096)
    rng = random.Random(2)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (60, 200, 3000)]
    rows = [(k, texts[k % 3] + (f" tail{k}" if k % 4 else "")) for k in range(60)] + [(5, texts[2] + " tail5")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df, shingle=5).collect()}
    assert got == brute.near_texts(rows[:60], 5, 80, 100)


# -- search, clashes ----------------------------------------------------------------------------


def test_scores_beyond_a_long(spark):
    """Ranked by what they are, above and below a long's ends, and shown as those."""
    rows = [(1, [1e16, 1.0]), (2, [1e16, 2.0]), (3, [1e16, 3.0]), (4, [-1e16, 1.0]), (5, [-2e16, 1.0]), (6, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") == 1, 9).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(3, 2**63 - 1), (2, 2**63 - 1), (6, 1 << 20), (4, -(2**63)), (5, -(2**63))]


@pytest.mark.parametrize("clustered", [True, False])
def test_search_in_cells(spark, clustered):
    """Against all scores; on clustered vectors most cells are passed over."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 16)) * (1 if clustered else 0)
    x = centres[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 16)) * (0.05 if clustered else 1)
    x[100] = x[200]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, x[0, :8].tolist()), (5050, x[1, :8].tolist()), (0, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5, tree_rows=200, pilot=64, cells=24).collect())
    whole = np.floor(1024 * np.array([v for _, v in rows if len(v) == 16])).astype(np.int64)
    ids = [i for i, v in rows if len(v) == 16]
    want = []
    for i in range(0, 3000, 50):
        best = sorted((-int(s), j) for s, j in zip(whole @ whole[i], ids) if j != i)[:5]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    short = np.floor(1024 * x[:2, :8]).astype(np.int64)
    want += [(5000, 1, 5050, int(short[0] @ short[1])), (5050, 1, 5000, int(short[0] @ short[1]))]
    assert got == sorted(want)
    router = topk.Router([(i, np.floor(1024 * v).tolist()) for i, v in enumerate(x[:64])], 24, 5)
    import pyarrow as pa

    lists = pa.array([np.floor(1024 * v).tolist() for v in x], pa.list_(pa.float64()))
    cell, far = router.nearest(lists)
    reach = {int(c): (1, float(far[cell == c].max())) for c in np.unique(cell)}
    visited = len(router.visits(pa.array(range(64)), lists.slice(0, 64), reach)[0]) / (64 * len(reach))
    assert visited < 0.6 if clustered else visited <= 1


OWN = ("_weak", "_covered", "_row", "_linked", "_language", "_rule", "_address", "_node", "_alias", "_aside0")


def test_columns_of_the_same_names_stay(spark):
    docs = spark.createDataFrame([(1, "user: ann password: hunter22", "en"), (2, "hello there", "en")], "doc_id bigint, text string, lang string").withColumns({n: F.lit(n) for n in OWN})
    pages = docs.withColumns({"url": F.lit("http://a.com/x"), "html": F.lit('<link rel=canonical href="/y">')})
    for out in (secrets.scan_secrets(docs), langid.language_id(docs), urls.judge_urls(pages, [("com", "/", "allow")])):
        assert {n: r[n] for r in out.collect() for n in OWN} == {n: n for n in OWN}


# -- the pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    """Each stage against its plain version on its own input, and the packing of what is left."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    scored = {r["doc_id"]: r for r in langid.language_id(docs).collect()}
    want = {i for i, r in scored.items() if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.MIN_SCORE}
    first = corpus_pipeline.identify_language(spark, docs, SMALL).collect()
    assert {r["doc_id"] for r in first} == want and all(r["lang"] == scored[r["doc_id"]]["lang_pred"] for r in first)

    kept = spark.createDataFrame(first, docs.schema)
    texts = [(r["doc_id"], r["text"]) for r in first]
    classes = brute.near_texts(texts, 5, 80, 100)
    second = corpus_pipeline.drop_near_duplicates(spark, kept, SMALL).collect()
    assert {r["doc_id"] for r in second} == {i for i, (_, c) in classes.items() if i == c}

    third = corpus_pipeline.redact_secrets(spark, spark.createDataFrame(second, docs.schema), SMALL).collect()
    before = {r["doc_id"]: r for r in second}
    assert len(third) == len(second)
    for r in third:
        spans = brute.base_spans(before[r["doc_id"]]["text"])
        assert all(before[r["doc_id"]]["text"][a:b] not in r["text"] for a, _, b, _ in spans)
        if "[REDACTED]" not in r["text"]:
            assert (r["text"], r["n_chars"]) == (before[r["doc_id"]]["text"], before[r["doc_id"]]["n_chars"])
        else:
            assert r["n_chars"] == len(r["text"])

    packed = corpus_pipeline.pack_documents(spark, spark.createDataFrame(third, docs.schema), SMALL).collect()
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r["doc_id"]: coder.encode(r["text"], add_special_tokens=False).ids + [0] for r in third}
    pieces = {(r["doc_id"], r["piece"]): list(r["ids"]) for r in packed}
    assert pieces == {(i, k): x[at : at + 2048] for i, x in ids.items() for k, at in enumerate(range(0, len(x), 2048))}
    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)
