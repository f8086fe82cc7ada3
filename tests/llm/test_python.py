"""SimHash, BPE, chat, top-k, language ID and quality against brute force, round trips and held-out labels."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from almanac.llm import bpe, chat, components, langid, quality, queries, simhash, topk
from almanac.llm.common import fold
from tests.llm import data

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    up = {k: k for k in range(len(fps))}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                up[max(root(a), root(b))] = min(root(a), root(b))
    return [root(k) for k in range(len(fps))]


def test_simhash(spark):
    for docs in (data.documents(spark), spark.read.parquet(f"{data.DATA}/documents.parquet")):
        rows = docs.select("doc_id", "text").collect()
        fps = [brute_fingerprint(r.text) for r in rows]
        roots = brute_components(fps)
        least = {}
        for r, c in zip(rows, roots, strict=True):
            if r.doc_id is not None:
                least[c] = min(least.get(c, r.doc_id), r.doc_id)
        want = Counter((r.doc_id, f, least.get(c)) for r, f, c in zip(rows, fps, roots, strict=True))
        got = Counter((r.id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect())
        assert got == want
    kept = simhash.deduplicated(data.documents(spark))
    assert kept.columns == data.documents(spark).columns
    assert Counter(r.doc_id for r in kept.collect())[0] == 1 and 1 not in {r.doc_id for r in kept.collect()}
    assert simhash.near_duplicates(data.empty(spark)).count() == 0 and simhash.deduplicated(data.empty(spark)).count() == 0


def test_deduplicated_with_and_without_a_broadcast(spark, monkeypatch):
    docs = data.documents(spark).unionByName(spark.read.parquet(f"{data.DATA}/documents.parquet").withColumns({"doc_id": F.col("doc_id") + 1000, "id": F.lit(""), "size": F.lit(""), "kept": F.lit(2)}).withColumn("n_chars", F.col("n_chars")))
    docs = docs.unionByName(docs.where("doc_id = 9").withColumn("text", F.lit("a differing text of a repeated id, which is not the least")))
    rows = docs.select("doc_id", "text").collect()
    roots, least = brute_components([brute_fingerprint(r.text) for r in rows]), {}
    for r, c in zip(rows, roots, strict=True):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    ids = Counter(r.doc_id for r, c in zip(rows, roots, strict=True) if r.doc_id is None or least[c] == r.doc_id)
    want = Counter({k: n if k is None else 1 for k, n in ids.items()})
    assert Counter(r.doc_id for r in simhash.deduplicated(docs).collect()) == want
    monkeypatch.setattr(simhash, "FEW", 0)
    assert Counter(r.doc_id for r in simhash.deduplicated(docs).collect()) == want


def test_simhash_links_near_values_in_crowded_shards(spark, monkeypatch):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(12)}
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    monkeypatch.setattr(simhash, "CHUNK", 40)
    monkeypatch.setattr(simhash, "SHARD", 200)
    reps = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    got = {r.node: r.component for r in components.components(simhash.links(reps, len(fps))).collect()}
    roots = brute_components([f % (1 << 64) for f in fps])
    groups = Counter(roots)
    for f, c in zip(fps, roots, strict=True):
        assert (f in got) == (groups[c] > 1)
    same = {}
    for f, c in zip(fps, roots, strict=True):
        if f in got:
            assert same.setdefault(c, got[f]) == got[f]
    assert len(set(same.values())) == len(same)


@pytest.mark.parametrize("depth", [1, 5, 10])
def test_tree_keeps_neighbours_together(depth):
    starts, leaves = simhash.tree(depth)
    rng = np.random.default_rng(depth)
    for v in rng.integers(0, 65536, 300):
        own = set(leaves[starts[v] : starts[v + 1]].tolist())
        assert own
        for b in range(16):
            w = int(v) ^ (1 << b)
            assert own & set(leaves[starts[w] : starts[w + 1]].tolist())


def test_components(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 400), (400, 450), (900, 1000), (7, 7)] + [(2000, 2000 + k) for k in range(1, 300)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint").repartition(7)).collect()}
    assert all(got[k] == 0 for k in range(201)) and got[500] == got[450] == 400 and got[1000] == 900 and got[2299] == 2000


@pytest.fixture(scope="module")
def encoders():
    with open(PATH, "rb") as f:
        ranks = bpe.load_ranks(f.read())
    return bpe.Encoder(ranks), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "\xa0", "a", "B", "é", "1", "½", "!", "中", "\U0001f642", "d", "ve", "the", "\x1c", "\x85", "ing", "anti", "0000", "    ", "ß"]), max_size=20).map("".join) | st.text(max_size=40))
def test_bpe_equals_the_library(encoders, text):
    own, library = encoders
    ids = own.ids(text)
    assert ids.tolist() == library.encode_ordinary(text)
    assert bpe.decode(ids, own.machine.tokens, step=1) == text


def test_stream_decoder():
    whole = "aé中\U0001f642z".encode()
    for cut in range(len(whole)):
        d = bpe.StreamDecoder()
        assert d.feed(whole[:cut]) + d.feed(whole[cut:]) + d.end() == whole.decode()
    d = bpe.StreamDecoder()
    assert d.feed(b"a\xe4\xb8") + d.end() == "a�"


def test_bpe_documents(spark, encoders):
    docs = data.documents(spark)
    got = Counter((r.id, tuple(r.ids), r.decoded) for r in bpe.encode_documents(docs, PATH).collect())
    assert got == Counter((r.doc_id, tuple(encoders[1].encode_ordinary(r.text or "")), r.text or "") for r in docs.collect())
    assert bpe.encode_documents(data.empty(spark), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=8), st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "|", "\n", "a", "[", "<\\|im_end|>", "<|im_", "end|>"]), max_size=12).map("".join))
def test_chat_round_trip(role, text):
    rendered = chat.render_turn(role, text)
    assert chat.parse_turn(rendered) == (role, text)
    assert list(chat.parse_stream([rendered[:5], rendered[5:] + rendered])) == [(role, text)] * 2
    body = rendered[len(chat.START) : -len(chat.END) - 1]
    assert not any(c in body for c in chat.CONTROLS)


def test_chat_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "x<|im_end|>y"), (1, 2, "assistant", None), (2, 1, "assistant", "b"), (2, 0, "user", "a"), (None, None, None, None), (3, 0, "user", "only"), (3, 0, "user", "only")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").withColumn("n_turns", F.lit("clash"))
    got = {r.conv_id: r for r in chat.digest_conversations(chat.format_conversations(turns)).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\nhi\nassistant\nx<|im_end|>y\nassistant\n\n").hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(b"x<|im_end|>y").hexdigest() and got[1].loss_chars == 12 and got[1].n_turns == 3
    assert got[2].turns_sha256 == hashlib.sha256(b"user\na\nassistant\nb\n").hexdigest() and got[3].n_turns == 2 and got[None].n_turns == 1
    assert chat.digest_conversations(chat.format_conversations(turns.where("false"))).count() == 0


def brute_top(rows, is_query, k):
    """Each query row against all other rows, equal ones too."""
    for at, (q, x) in enumerate(rows):
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(x, v, strict=True)), i) for n, (i, v) in enumerate(rows) if n != at and len(v) == len(x))
            yield from ((q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k]))


def test_topk(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = [(k, [float(np.float32(v)) for v in rng.normal(size=6)]) for k in range(400)] + [(k, [0.5] * 6) for k in range(400, 500)]
    # Ids that repeat, with the same vector and with another, as candidates and as queries; empty vectors; other lengths.
    again = [(7, vectors[7][1]), (40, vectors[40][1]), (40, [2.0] * 6), (60, [0.5] * 6), *[(80, [1.5] * 6)] * 40]
    odd = [(600, None), (601, [1.0, None]), (602, [float("nan")] * 6), (603, [float("inf")] * 6), (None, [1.0] * 6)]
    other = [(604, [1.0, 2.0]), (605, [3.0, 4.0]), (620, []), (621, []), (640, [1.0] * 3)]
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors + again + odd + other], "vec_id bigint, embedding array<float>, score string")
    clean = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in [*vectors, *again, *other]]
    want = sorted(brute_top(clean, lambda q: q % 20 == 0 or q == 604, 20))
    for part in (90, 100_000):
        monkeypatch.setattr(topk, "PART", part)
        got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id % 20 = 0 OR vec_id = 604"), 20).collect())
        assert got == want
    assert topk.top_k(df.where("false"), df, 5).count() == 0 and topk.top_k(df, df.where("false"), 5).count() == 0


def test_topk_leaves_out_blocks_of_clusters():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 16)) * 200
    rows = np.floor(np.repeat(centres, 64, axis=0) + rng.normal(size=(60 * 64, 16)) * 4)
    part, ids = topk.Part(np.arange(len(rows)), np.ones(len(rows), int), rows), np.arange(0, len(rows), 100)
    found = list(part.best(ids, rows[ids], np.full(len(ids), topk.NONE), 10))
    for q, (got_ids, got) in zip(ids, found, strict=True):
        exact = sorted((-int(s), i) for i, s in enumerate(rows @ rows[q]) if i != q)[:10]
        assert [(-s, i) for s, i in exact] == [(int(s), i) for s, i in zip(got, got_ids, strict=True)]
    assert part.scored < 0.2 * part.met


def test_topk_sends_queries_only_where_they_can_reach(spark, monkeypatch):
    """Vectors that stand in clusters by their ids: less than half of all pairs of query and part are sent."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16)) * 8
    vectors = np.repeat(centres, 50, axis=0) + rng.normal(size=(2000, 16)) * 0.2
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(topk, "PART", 100)
    sent, reached = [], topk._reached
    monkeypatch.setattr(topk, "_reached", lambda *a: sent.append(reached(*a)) or sent[-1])
    clean = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in enumerate(vectors.tolist())]
    want = sorted(brute_top(clean, lambda q: q % 20 == 0, 5))
    for pieces in (8_000_000, 200):
        monkeypatch.setattr(topk, "SENT", pieces)
        sent.clear()
        got = topk.top_k(df, df.where("vec_id % 20 = 0"), 5).collect()
        assert sorted(map(tuple, got)) == want
        # Homes first, then what else can be reached, in one piece of the bounds or several.
        n = len(sent) // 2
        assert (n == 1) == (pieces > 200) and 100 + sum(x.count() for x in sent[n:]) < 0.5 * 100 * 20


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_against_duckdb(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data.DATA}/{t}.parquet'")
    df = queries.QUERIES[name](spark, data.DATA)
    assert Counter(map(tuple, c.execute(queries.ORACLES[name]).df()[df.columns].itertuples(index=False))) == Counter(tuple(r) for r in df.collect())


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = langid.train(docs, usable=fold("doc_id", 3) != 1)
    got = langid.identify(docs, models).join(docs.withColumnRenamed("lang", "own"), F.col("id") == F.col("doc_id")).where(fold("doc_id", 3) == 1)
    assert got.agg(F.avg((F.col("lang") == F.col("own")).cast("int"))).first()[0] > 0.97
    assert got.where("accepted").count() == got.count()
    for text, want in ((None, "und"), ("", "und"), ("12 !? 34", "und")):
        assert models.predict(text) == (want, 0.0, False)
    assert models.predict("e")[0] in models.langs and 0 <= models.predict("e")[1] <= 1
    rng = random.Random(1)
    assert not models.predict("".join(rng.choices("qzxjkvw", k=400)))[2]
    odd = data.documents(spark)
    assert langid.identify(odd, models).count() == odd.count() and langid.accepted_only(odd, models).columns == odd.columns
    assert langid.identify(data.empty(spark), models).count() == 0
    assert langid.train(data.empty(spark)).predict("text") == ("und", 0.0, False)


def test_language_limits_are_robust(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 200")
    models = langid.train(docs)
    rows = docs.where(fold("doc_id", 3) == 1).select("lang", "text").collect()
    rng = random.Random(1)
    junk = lambda n: "".join(rng.choices("qzxjkvw", k=n))
    for lang in models.langs:
        own = [r.text for r in rows if r.lang == lang][:40]
        long = " ".join(own)
        while len(long) < 1_000_000:
            long += " " + long
        long = "".join(rng.choice("qzxjkvw") if rng.random() < 0.05 else c for c in long)
        texts = [(lang, True, t) for t in [*own, long, "\u0436\u0448\u044f \u0444\u044b\u0432\u0430 " * 300]]
        langid._calibrate(models, spark.createDataFrame(texts, "lang string, back boolean, text string"))
        assert all(models.predict(t)[2] for t in own)
        assert not any(models.predict(text)[2] for n in (400, 3000) for text in [junk(n)] if models.predict(text)[0] == lang), lang
        bits = models.usual[models.langs.index(lang)] + models.slack[models.langs.index(lang)].max()
        assert bits < models.cross_entropy(langid.characters(junk(3000))).min(), lang


def test_quality(spark):
    where = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{where}/labels.parquet").select("doc_id", "quality")
    got = queries.op3_quality(spark, where).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95
    docs = spark.read.parquet(f"{where}/documents.parquet")
    trees = quality.train(docs, labels.unionByName(labels.limit(20)), usable=fold("doc_id", 5) != 0)
    odd = data.documents(spark)
    scored = quality.score(odd, trees).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    none = quality.train(docs, labels.where("false"))
    assert {r.score for r in quality.score(odd, none).collect()} == {0.5}
    assert quality.score(data.empty(spark), trees).count() == 0


def test_trees_learn_a_rule():
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(quality.FEATURES)))
    y = ((x[:, 3] > 0.5) ^ (x[:, 7] > 0.3)).astype(float)
    trees = quality.fit(x[:1500], y[:1500])
    assert ((trees.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.9


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data.DATA}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, data.DATA).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    source = spark.read.parquet(f"{data.DATA}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(out[n].columns == source.columns for n in names[:-1])
    first, second = (out[n].collect() for n in names[:2])
    roots = brute_components([brute_fingerprint(r.text) for r in sorted(first, key=lambda r: r.doc_id)])
    assert sorted(r.doc_id for r in second) == sorted(r.doc_id for k, r in enumerate(sorted(first, key=lambda r: r.doc_id)) if roots[k] == k)
    private = [r.text for r in out["pii"].collect() if re.search(r"@mail\d+\.example\.com|\+1 \(\d{3}\) 555-", r.text)]
    assert not private
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
    assert words(out["mixing"].collect()) == pytest.approx(1.5 * words(out["pii"].collect()), rel=0.2)
    assert out["bpe"].count() == out["mixing"].count()
    assert all(t == d for t, d in zip(sorted(r.decoded for r in out["bpe"].collect()), sorted(r.text for r in out["mixing"].collect()), strict=True))
