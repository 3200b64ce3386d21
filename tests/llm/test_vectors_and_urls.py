"""Searches over vectors against brute force, URL rules and models, and the registered queries."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweir.llm import catalog, flat_graph, inner_product, url_filter

SF_DIR = "/root/testdata/sf0.01"


def vectors(seed, n, width=8, near=0.4):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, width))
    for i in range(int(n * near)):
        rows[i] = rows[n // 2 + i % 20] + rng.normal(size=width) * 0.08
    return rows.astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"score": F.lit(1), "node": F.lit(2)}).repartition(3)


ODD = [(900, None), (901, []), (902, [1.0, None]), (903, [float("nan")] * 8), (904, [float("inf")] * 8), (905, [0.0] * 8), (906, [1.0, 2.0])]


def test_top_products_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(inner_product, "BLOCK", 16)
    monkeypatch.setattr(inner_product, "GROUP", 100)
    monkeypatch.setattr(inner_product, "SLICE", 2)
    data = [(i, v.tolist()) for i, v in enumerate(vectors(1, 500))] + [(500, vectors(1, 500)[3].tolist()), (7, vectors(1, 500)[7].tolist())]
    found = inner_product.top_products(frame(spark, data + ODD)).collect()
    whole = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in [*data, ODD[1], ODD[5], ODD[6]]]
    want = []
    for row, (q, v) in enumerate(whole):
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for other, (i, w) in enumerate(whole) if other != row)
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:10], 1)]
    assert sorted(tuple(r) for r in found) == sorted(want)
    assert inner_product.top_products(frame(spark, ODD[:1])).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(0, [3e38, 1.0]), (1, [3e38, 1.0]), (2, [1e-3, -2.5]), (3, [-3e38, 0.0])]
    found = [(r["vec_id"], r["score"]) for r in inner_product.top_products(frame(spark, rows)).orderBy("rank").collect()]
    assert [i for i, _ in found] == [1, 2, 3] and found[0][1] == 2**63 - 1 and found[2][1] == -(2**63)


def test_the_largest_doubles(spark):
    rows = [(0, [1e307, 1.0]), (1, [1e307, -1.0]), (2, [-1e307, 1e307]), (3, [0.0, 0.5]), (4, [1e-300, -1e307])]
    found = inner_product.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    most, least = 2**63 - 1, -(2**63)
    assert [(r["vec_id"], r["score"]) for r in found] == [(1, most), (3, 1024 * 512), (2, least), (4, least)]
    assert inner_product._products(np.array([[1e307, 1e307, 1.0]]), np.array([[1.0, -1.0, 0.5]]))[0, 0] == 1024 * 512


def test_scores_that_were_cut_hide_no_tie(spark, monkeypatch):
    monkeypatch.setattr(inner_product, "BLOCK", 4)
    monkeypatch.setattr(inner_product, "GROUP", 8)
    rows = [(i, [-1e300 * (i % 7 + 1), 1.0]) for i in range(1, 60)] + [(0, [1e300, 0.0])]
    found = inner_product.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in found) == [(i, i, -(2**63)) for i in range(1, 11)]


def test_queries_go_to_groups_that_may_hold_more(spark, monkeypatch):
    """Pairs of query and group that are sent, on clustered vectors; results equal brute force."""
    monkeypatch.setattr(inner_product, "GROUP", 64)
    monkeypatch.setattr(inner_product, "ENVELOPES", 5)
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(16, 8)) * 10
    data = np.concatenate([c + rng.normal(size=(64, 8)) * 0.1 for c in centers]).astype(np.float32)
    sent = []
    surviving = inner_product.surviving

    def counted(blocks, queries):
        pairs = surviving(blocks, queries)
        sent.append((pairs.count(), queries.count() * (blocks.select("group").distinct().count() - 1)))
        return pairs

    monkeypatch.setattr(inner_product, "surviving", counted)
    found = inner_product.top_products(frame(spark, [(i, v.tolist()) for i, v in enumerate(data)]), every=10).collect()
    whole = np.floor(data.astype(float) * 1024).astype(np.int64)
    want = []
    for q in range(0, len(data), 10):
        scores = sorted((-int(s), i) for i, s in enumerate(whole @ whole[q]) if i != q)[:10]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    assert sorted(tuple(r) for r in found) == sorted(want)
    assert sent[0][0] < sent[0][1] / 3


def test_near_duplicates_against_brute_force(spark):
    data = vectors(2, 600)
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(700, data[5].tolist()), (701, data[5].tolist()), *ODD]
    found = {r["vec_id"]: r for r in flat_graph.near_duplicates(frame(spark, rows)).collect()}
    sound = [(i, v) for i, v in rows if v and len(v) == 8 and np.isfinite(v).all() and np.any(v)]
    unit = np.array([v for _, v in sound], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    links = {i: int(n) for (i, _), n in zip(sound, near.sum(axis=1), strict=True)}
    assert len(found) == len(rows)
    assert sum(found[i]["n_links"] for i in links) >= 0.9 * sum(links.values())
    assert all(found[i]["n_links"] <= n for i, n in links.items())
    assert found[5]["n_links"] >= 2 and found[700]["component_id"] == found[5]["component_id"] <= 5
    for i, _ in ODD:
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())
    assert flat_graph.near_duplicates(frame(spark, ODD[:2])).count() == 2


def test_null_ids_and_recall_without_links(spark):
    rows = [(3, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 1.0]), (None, None), (7, [-1.0, 0.0]), (7, [-1.0, 0.0])]
    found = flat_graph.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1, r["kept"]) for r in found) == [
        (-1, 0, -1, True), (-1, 0, -1, True), (-1, 1, 3, False), (3, 1, 3, True), (7, 1, 7, True), (7, 1, 7, True)
    ]
    assert {r["recall"] for r in found} == {None}
    assert flat_graph.near_duplicates(frame(spark, rows).where("false")).count() == 0


def test_a_hot_cluster_is_cut(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "LARGEST", 64)
    monkeypatch.setattr(flat_graph, "SHARD", 600)
    nodes = flat_graph.classes(frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors(3, 600))]))
    shards = flat_graph.sharded(nodes, 2)
    assert shards.groupBy("cluster", "code").count().agg(F.max("count")).first()[0] < 600
    assert shards.select("node").distinct().count() == 600


def test_a_ball_of_near_equal_vectors_is_sliced_and_stays_whole(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "LARGEST", 128)
    monkeypatch.setattr(flat_graph, "SLICE", 48)
    monkeypatch.setattr(flat_graph, "SHARD", 600)
    rng = np.random.default_rng(4)
    ball = rng.normal(size=64) + rng.normal(size=(400, 64)) * 0.05
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([ball, rng.normal(size=(100, 64))]).astype(np.float32))]
    nodes = flat_graph.classes(frame(spark, rows))
    shards = flat_graph.sharded(nodes, 1)
    assert shards.select("node").distinct().count() == 500
    assert shards.groupBy("cluster", "code", "pair").count().agg(F.max("count")).first()[0] < 200
    found = {r["vec_id"]: r for r in flat_graph.near_duplicates(frame(spark, rows)).collect()}
    assert sum(found[i]["n_links"] for i in range(400)) >= 0.95 * 400 * 399
    assert all(found[i]["component_id"] == 0 for i in range(400))
    assert all((found[i]["n_links"], found[i]["kept"]) == (0, True) for i in range(400, 500))

    # Shards return at most a count and a spanning link per class, not the ball's 79,800 pairs.
    written = flat_graph.searched(nodes, np.zeros(0, np.int64), 1)
    per_kind = {r["kind"]: r["count"] for r in written.groupBy("kind").count().collect()}
    memberships = shards.count()
    assert per_kind.keys() == {flat_graph.COUNT, flat_graph.SPAN} and max(per_kind.values()) <= memberships < 79_800


def test_links_of_overlapping_shards_are_counted_once(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "LARGEST", 64)
    monkeypatch.setattr(flat_graph, "SLICE", 40)
    monkeypatch.setattr(flat_graph, "SHARD", 100)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    data = np.repeat(centres, 12, axis=0) + rng.normal(size=(480, 16)) * 0.12
    data = np.concatenate([data, data[:30]])  # copies
    found = {r["vec_id"]: r for r in flat_graph.near_duplicates(frame(spark, [(i, v.tolist()) for i, v in enumerate(data)])).collect()}
    unit = data.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    got, true = np.array([found[i]["n_links"] for i in range(len(data))]), near.sum(axis=1)
    assert (got <= true).all() and got.sum() >= 0.98 * true.sum() > 0
    assert found[0]["recall"] >= 0.9


URLS = [
    ("http://a.NET/x?q#f", "a.net", "/x", "net/", "block"),
    ("http://a.net", "a.net", "", None, None),
    ("https://www.example.net/en/1", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("x://example.com/de/#y", "example.com", "/de/", "example.com/de/", "block"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, None),
    ("http://é.ORG/fr/É?", "é.org", "/fr/É", "org/fr/", "allow"),
    ("no scheme.net/", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("http://h?p/net/", "h", "", None, None),
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("score", F.lit(1))
    found = {r["page_id"]: r for r in url_filter.judged(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        r = found[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert url_filter.judged(pages.where("false")).count() == 0


def test_url_model_against_brute_force(spark):
    """Scores of the interpolated models, worked out one URL at a time."""
    import zlib
    from collections import Counter, defaultdict

    urls = [(i, f"http://{h}{i % 7}.example.{t}/{p}/{i * 37 % 100}") for i in range(400) for h, t, p in [[("good", "org", "fr"), ("bad", "net", "x"), ("new", "com", "en"), ("bad", "com", "de")][i % 4]]]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    found = {r["page_id"]: r for r in url_filter.judged(pages).collect()}

    def fold(url):
        return "^^^" + "".join("0" if c.isdigit() else c for c in url)

    counts = {"allow": defaultdict(Counter), "block": defaultdict(Counter)}
    for i, url in urls:
        if found[i]["rule"] and zlib.crc32(str(i).encode()) % 5:
            text = fold(url)
            for at in range(3, len(text)):
                for order in range(4):
                    counts[found[i]["verdict"]][text[at - order : at]][text[at]] += 1

    def probability(side, context, symbol):
        p = 1 / url_filter.SYMBOLS
        for order in range(4):
            seen = counts[side].get(context[3 - order :])
            if seen:
                p = (seen[symbol] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p

    for i, url in urls[::9]:
        text = fold(url)
        logs = [math.log(probability("block", text[at - 3 : at], text[at]) / probability("allow", text[at - 3 : at], text[at])) for at in range(3, len(text))]
        assert found[i]["score"] == pytest.approx(sum(logs) / len(logs), abs=1e-9)
        if not found[i]["rule"]:
            assert found[i]["verdict"] == ("block" if found[i]["score"] > found[i]["cut"] else "allow")


def test_urls_without_a_character_are_allowed(spark):
    """Beside a model whose threshold is below zero, and repeated rows and a very long URL."""
    urls = [f"http://{'good.org/fr/' if i % 2 else 'bad.net/'}{i % 13}" for i in range(200)]
    rows = [*enumerate(urls), (900, None), (901, ""), (901, ""), (902, "http://bad.com/" + "x" * 50_000)]
    found = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(found) == len(rows)
    assert [(r["verdict"], r["score"]) for r in found if r["page_id"] in (900, 901)] == [("allow", 0.0)] * 3


@pytest.mark.parametrize("name", catalog.ORACLES)
def test_queries_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = catalog.QUERIES[name](spark, SF_DIR)
    want = duck.execute(f"SELECT {', '.join(result.columns)} FROM ({catalog.ORACLES[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in result.collect())


def test_pipeline(spark):
    """Every stage's columns and rows, and its last stage against the library."""
    import hashlib

    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    from eventweir.llm.tables import staged

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, before, "/root/testdata/sf0.001"), name)
        assert docs.columns == columns and docs.count() > 0
        assert docs.select("doc_id").exceptAll(before.select("doc_id")).count() == 0 or name == "mixing"
        before = docs
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = sorted((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.STAGES[-1][1](spark, docs, "").collect())
    assert got == [(i, hashlib.sha256(",".join(map(str, library.encode(t, add_special_tokens=False).ids)).encode()).hexdigest()) for i, t in texts]
