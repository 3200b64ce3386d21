"""Operators on texts: brute force, exact round trips, held-out accuracy, and odd inputs."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from eventweir.llm import bpe, language, licenses, mixing, personal_data, samples, simhash, toxicity

SF_DIR = "/root/testdata/sf0.01"
ODD = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \t\n ", "en", "b"),
    (4, "One two three four five.", "en", "a"),
    (4, "One two three four five.", "en", "a"),
    (None, "one TWO three four five.", "fr", None),
    (6, "mot " * 30_000, "fr", "a"),
    (7, "x" * 100_000, None, "b"),
    (8, "é 😀 \u200b <|endoftext|> 1.2.3.4 a@b.co", "en", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    clashing = ["score", "size", "ids", "base", "held_out", "target", "copies", "n_chars", "decoded"]
    return rows.withColumns({name: F.lit(1) for name in clashing}).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_bpe_equals_the_library(docs, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = docs.select("doc_id", "text").limit(100).unionByName(odd.select("doc_id", "text"))
    for r in bpe.encode_decode(rows).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert "ids_" in bpe.encode_decode(odd).columns and bpe.digests(none).count() == 0


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    import xxhash

    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id reachable, of (id, fingerprint) rows."""
    low = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for i, p in prints:
            best = min(low[j] for j, q in prints if (p ^ q).bit_count() <= 3)
            if best < low[i]:
                low[i], changed = best, True
    return low


def test_simhash_against_brute_force(spark, docs, odd):
    rows = docs.select("doc_id", "text").where("length(text) < 1500").limit(250)
    found = simhash.components(rows).collect()
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    prints = [(i, brute_print(t)) for i, t in texts.items()]
    assert {r["doc_id"]: r["fingerprint"] % 2**64 for r in found} == dict(prints)
    assert {r["doc_id"]: r["component"] for r in found} == brute_components(prints)
    some = [(r["doc_id"], r["component"]) for r in simhash.components(odd).collect()]
    assert sorted(some, key=str) == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (None, 4), (6, 6), (7, 7), (8, 8)], key=str)
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns
    # Ids 1 to 3 have no words; the null id's text is that of id 4, which is there twice.
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "6", "7", "8"]


def test_rows_not_ids_are_kept(spark):
    """Rows that share an id and are unlike each other stay both; copies without an id are one."""
    texts = ["first text of some length", "another one, not like it", "a third that has no copy"]
    rows = [(5, texts[0]), (5, texts[1]), (3, texts[0]), (None, texts[2]), (None, texts[2]), (7, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("a.b", F.lit(1)).withColumn("row", F.lit(2))
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == sorted([("3", texts[0]), ("5", texts[1]), ("None", texts[2])])
    assert simhash.representatives(docs.where("false")).count() == 0


def test_simhash_index_loses_no_link(spark, monkeypatch):
    """Balls of near fingerprints, over many small blocks; groups are pruned at the upper levels."""
    import random

    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(200)}
    for base in list(prints)[:3]:
        for _ in range(150):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    ids = dict(enumerate(sorted(prints)))
    signed = [(i, p - 2**64 if p >= 2**63 else p) for i, p in ids.items()]
    nodes = spark.createDataFrame(signed, "first long, node long").repartition(5)
    links = simhash.near_links(nodes.select(F.col("node").alias("fingerprint")))
    found = simhash.lowest_reachable(nodes, links)
    got = {r["node"] % 2**64: r["component"] for r in found.collect()}
    assert {i: got[p] for i, p in ids.items()} == brute_components(list(ids.items()))
    assert simhash.lowest_reachable(nodes.where("false"), links.where("false")).count() == 0
    none = nodes.where("false").select(F.col("node").alias("fingerprint"))
    assert simhash.near_links(none).count() == 0


def test_groups_of_the_table_are_pruned(spark, monkeypatch):
    """On the fingerprints of a whole table most pairs of blocks are never searched."""
    monkeypatch.setattr(simhash, "BLOCK", 2)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prints = simhash.components(docs).select("fingerprint").distinct()
    blocks = simhash.index_blocks(prints)
    pairs, left = simhash.near_blocks(blocks)
    n = blocks.count()
    assert n > 400 and left[-1] == pairs.count() < n * (n + 1) / 4
    assert blocks.agg(F.sum(F.octet_length("prints"))).first()[0] == 8 * prints.count()


def test_block_links_are_all_links():
    import numpy as np

    rng = np.random.default_rng(0)
    prints = np.unique(rng.integers(0, 1 << 10, 300).astype(np.uint64) << np.uint64(20))
    prints = prints[np.argsort(simhash.gray_rank(prints))]
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    found = {tuple(p) for pairs in simhash.block_links(prints) for p in pairs.tolist()}
    assert found == {(i, j) for i, j in zip(*np.nonzero(near), strict=True) if i < j}
    for cut in (1, 7, 100, 170):  # two blocks of unlike size
        found = {tuple(p) for pairs in simhash.block_links(prints[:cut], prints[cut:]) for p in pairs.tolist()}
        assert found == set(zip(*[x.tolist() for x in np.nonzero(near[:cut, cut:])], strict=True))


def test_gray_rank_in_sql(spark):
    import numpy as np

    prints = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 200)
    rows = spark.createDataFrame([(int(x),) for x in prints], "p long").select("p", simhash._ranked(F.col("p")).alias("r")).orderBy("r").collect()
    ranks = simhash.gray_rank(np.array([r["p"] for r in rows]).view(np.uint64))
    assert (np.diff(ranks.astype(object)) > 0).all()


def test_long_texts_are_learned_from(spark):
    """A language that only long texts have, and texts that share an id with those of another."""
    french, english = "le chat est sur la table et le chien dort ", "the cat is on the table and the dog sleeps "
    rows = [(i, french * 600, "fr") for i in range(40)] + [(100 + i, f"{english} {i}", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {(r["lang"], r["lang_pred"]) for r in language.identified(docs).collect()} == {("fr", "fr"), ("en", "en")}
    shared = spark.createDataFrame([(1, f"{t} {i}", lang) for i in range(300) for t, lang in ((french, "fr"), (english, "en"))], docs.schema)
    assert {(r["lang"], r["lang_pred"]) for r in language.identified(shared).collect()} == {("fr", "fr"), ("en", "en")}


def test_samples_are_bounded_and_spread(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "concat(repeat('a', 990), repeat('b', 10), cast(id as string)) as text", "if(id % 3 = 0, 'x', 'y') as label")
    found = samples.labelled_sample(rows, 50, 4, 10)
    assert {y: sum(1 for _, label in found if label == y) for y in "xy"} == {"x": 50, "y": 50}
    assert all(len(pieces) == 4 and all(len(p) == 10 for p in pieces) and pieces[0] == "a" * 10 and "b" in pieces[3] for pieces, _ in found)
    assert found == samples.labelled_sample(rows.repartition(7), 50, 4, 10)
    assert samples.labelled_sample(rows.where("false"), 5, 4, 10) == []
    whole = spark.createDataFrame([(1, "abcdefghij", "x"), (2, "", "x"), (3, None, "x"), (4, "q", None)], "doc_id long, text string, label string")
    assert samples.labelled_sample(whole, 5, 4, 3) == [(["abc", "def", "ghi", "j"], "x")]


def test_labels_beside_texts_give_the_same_sample_and_move_no_text(spark):
    """Long ids, ids with several texts, whole rows that repeat, rows without a label, id or text."""
    texts = [(i % 40, f"text {i % 70} " * (i % 7)) for i in range(400)] + [(None, "no id"), (3, None), (4, ""), (99, "no label")]
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (50, None), (60, 1)], "doc_id long, label int")
    for most in (1000, 90, 7):
        want = samples.labelled_sample(rows.join(labels, "doc_id"), most, 3, 10)
        assert samples.labelled_sample(rows, most, 3, 10, labels) == want and len(want) == 2 * min(most, sum(1 for i, t in texts if t and i is not None and i < 40) // 2)
    assert samples.labelled_sample(rows.where("false"), 5, 4, 10, labels) == []
    seen = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(samples, "_first_rows", lambda rows, *rest: seen.append(rows.columns) or kept(rows, *rest)) if (kept := samples._first_rows) else None
        samples.labelled_sample(rows, 7, 3, 10, labels)
    assert seen == [["doc_id", "place", "label"]]


def test_toxicity_of_odd_texts_by_a_fitted_model(spark):
    rng = random.Random(1)
    bad, good = "you stupid worthless moron", "quiet green pond"
    nonsense = ["".join(rng.choice("aeioubcdlmnprst") for _ in range(6)) for _ in range(500)]
    rows = [(i, " ".join([*rng.sample(nonsense, 12), bad if i % 2 else good, *rng.sample(nonsense, 12)]), i % 2) for i in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, 0), (1, 1), (None, 1)], "doc_id long, toxic int")
    strange = [(None, f"{bad} again"), (7001, None), (7002, ""), (7003, " \t "), (7004, f"{good} " * 4000), (7005, f"{good} " * 2000 + f"{bad} " * 2000), (7005, "word")]
    got = toxicity.scored(docs.unionByName(spark.createDataFrame(strange, docs.schema)), labels)
    assert got.count() == 907 and got.where("score is null or score < 0 or score > 1").count() == 0
    found = {(r["doc_id"], (r["text"] or "")[:9]): r["predicted"] for r in got.where("doc_id > 7000 or doc_id is null").collect()}
    assert found[None, bad[:9]] == 1 and found[7004, good[:9]] == 0 and found[7005, good[:9]] == 1, found
    assert found[7001, ""] == found[7002, ""] == found[7003, " \t "] == 0


def test_mix_follows_inclusion_odds(spark):
    """Many sources alike: documents are in the sample as often as their words say."""
    rows = spark.range(600 * 10).selectExpr("id as doc_id", "repeat('w ', cast(id % 10 + 1 as int)) as text", "cast(id div 10 as string) as source")
    got = mixing.mixed(rows).where("source_size = 55").groupBy("size", "target").agg(F.avg("copies").alias("often"), F.count("*").alias("n")).collect()
    for r in got:
        whole, rest = int(r["target"] // 55), r["target"] % 55
        if not rest:
            continue
        odds = min(1.0, rest * r["size"] / 385)
        # The sample stops near the target's word, so small departures remain.
        assert abs(r["often"] - whole - odds) < 0.12 if rest * 10 / 385 <= 1 else r["often"] - whole <= 1
    assert len({r["target"] for r in got}) == 3


def test_rows_without_an_id_of_their_own_meet_the_target(spark):
    rows = spark.range(2000).selectExpr("if(id < 1000, null, 5L) as doc_id", "repeat('w ', 100) as text", "if(id < 1000, 'a', 'b') as source")
    got = mixing.mixed(rows.unionAll(spark.range(100, 900).selectExpr("id", "repeat('w ', cast(id % 50 as int))", "'c'")))
    for r in got.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target"), F.max("copies").alias("most")).collect():
        assert abs(r["taken"] - r["target"]) <= 50 and r["most"] <= 3


def test_mix_meets_targets(spark, odd, none):
    rows = [(i, "w " * (1 + i * 7919 % 200), f"s{i % 5 if i % 3 else 0}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    first = mixing.mixed(docs).collect()
    assert sorted(first) == sorted(mixing.mixed(docs.repartition(2)).collect())
    total, sources = sum(r["size"] for r in first), {}
    for r in first:
        assert 0 <= r["copies"] <= 3
        s = sources.setdefault(r["source"], [r["source_size"], r["target"], 0])
        s[2] += r["size"] * r["copies"]
    assert abs(sum(t for _, t, _ in sources.values()) - total) < 1e-6 * total
    for size, target, taken in sources.values():
        assert target <= 3 * size + 1e-6 and abs(taken - target) <= 100
    found = mixing.mixed(odd)
    assert {"size_", "source_size", "target_", "copies_"} <= set(found.columns) and found.count() == len(ODD)
    assert mixing.take(odd).columns == odd.columns and mixing.mixed(none).count() == 0


def test_water_filling_against_iteration(spark):
    sizes = {"a": 1, "b": 1, "c": 1, "d": 500, "e": 2, None: 40}
    rows = [(s, n) for s, n in sizes.items()]
    found = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full: set = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in sizes if s not in full)
        more = {s for s in sizes if s not in full and level * weight[s] > 3 * sizes[s]}
        if not more:
            break
        full |= more
    for s in sizes:
        assert found[s] == pytest.approx(3 * sizes[s] if s in full else level * weight[s])


def test_licences(spark, none):
    texts = [
        (1, "x Licensed under CC BY-NC 4.0. All rights reserved. y"),
        (2, "the GNU General Public License; general PUBLIC license"),
        (3, "see the MIT License."),
        (4, "mit der license of apache"),
        (5, None),
        (6, "cc-by cc by " + "word " * 50_000 + "all-rights reserved"),
        (7, "Licensed under the Apache License, Version 2.0"),
        (8, "genéral public license and İ K"),
    ]
    found = by_id(licenses.licences(spark.createDataFrame(texts, "doc_id long, text string").withColumn("row", F.lit(1))))
    assert [found[i]["labels"] for i in range(1, 9)] == ["cc-by,cc-by-nc,reserved", "gpl", "mit", "", "", "cc-by,reserved", "apache", ""]
    assert found[1].asDict()["base_labels"] == "cc-by,reserved"
    assert (found[2]["n_words"], found[2]["n_base"], found[2]["first_word"], found[2]["last_word"]) == (8, 2, 2, 5)
    assert (found[6]["n_base"], found[6]["first_word"], found[6]["last_word"]) == (3, 0, 50_004)
    assert found[5]["first_word"] is None and found[5]["score"] == 0 and 0 < found[3]["score"] <= 1
    assert licenses.licences(none).count() == 0


ISC = "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted"


def test_a_licence_does_not_displace_another(spark):
    """A notices file, in a corpus where the words of its other licences are rarer than MIT's."""
    texts = [(1, f"{ISC}. {BSD}. Released under the MIT License."), *[(i, "released under the mit license") for i in range(2, 9)]]
    found = by_id(licenses.licences(spark.createDataFrame(texts, "doc_id long, text string")))
    assert found[1]["labels"] == "bsd,isc,mit" and found[1]["score"] == 1
    every = " ".join(f"{text}. word{i}" for i, (_, _, text) in enumerate(licenses.TEMPLATES))
    found = by_id(licenses.licences(spark.createDataFrame([(1, every)], "doc_id long, text string")))
    assert set(found[1]["labels"].split(",")) == {label for label, _, _ in licenses.TEMPLATES}


def test_templates_have_their_key_phrases():
    assert all(licenses.spaced(key) in licenses.spaced(text) for _, key, text in licenses.TEMPLATES)
    assert all(set(key.split()) & set(licenses.gate()) for _, key, _ in licenses.TEMPLATES)
    assert len({label for label, _, _ in licenses.TEMPLATES}) >= 30


def test_anchors_are_chosen_by_idf():
    """The same body has other anchors in a corpus where its rarest words are common."""
    body = next(i for i, (label, _, _) in enumerate(licenses.TEMPLATES) if label == "agpl")
    words = {word for word, template, _ in licenses.postings() if template == body}
    rare = {word: 1 for word, _, _ in licenses.postings()}
    few = {word for word, template, _, _ in licenses.anchors(1000, rare) if template == body}
    assert len(few) == licenses.ANCHORS < len(words)
    counted = licenses.anchors(1000, rare | dict.fromkeys(few, 900))
    other = {word for word, template, _, _ in counted if template == body}
    assert len(few & other) == max(0, 2 * licenses.ANCHORS - len(words))
    for template in range(len(licenses.TEMPLATES)):
        assert sum(share for _, t, _, share in counted if t == template) == pytest.approx(1)
    assert licenses.anchors(0, {}) == []


def test_names_bodies_and_denials(spark):
    agpl = "free software you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"
    texts = {
        "we do not use the apache license": "",
        "this is not under the mit license nor the mozilla public license": "",
        "This is not legal advice, and the file comes to you under the MIT License": "mit",
        "not the Apache License. We chose, all of us, for all of it, the Apache License": "apache",
        "Permission is hereby granted, free of charge, to anyone": "mit",
        "CC0 1.0 Universal": "cc0", "Eclipse Public License - v 2.0": "epl", "under GNU GPL v3": "gpl",
        "// SPDX-License-Identifier: EPL-2.0": "epl", "SPDX-License-Identifier: BSD-3-Clause": "bsd",
        agpl: "agpl,gpl", agpl.replace("Affero General Public License", "affero something"): "",
        "software foundation free modify redistribute": "", "": "",
    }
    rows = [*enumerate(texts), *enumerate(texts)]
    found = licenses.licences(spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit(1))).collect()
    assert len(found) == len(rows)
    assert {list(texts)[r["doc_id"]]: r["labels"] for r in found} == texts


def test_base_columns_against_a_plain_search(spark):
    """Every document of a table, word by word."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = by_id(licenses.licences(spark.createDataFrame(docs)))
    for doc_id, text in docs:
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places = {label: [i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()] for p, label in licenses.BASE.items()}
        every = sorted(i for own in places.values() for i in own)
        r = found[doc_id]
        assert (r["n_words"], r["n_base"]) == (len(words), len(every))
        assert (r["first_word"], r["last_word"]) == ((every[0], every[-1]) if every else (None, None))
        assert r["base_labels"] == ",".join(sorted(label for label, own in places.items() if own))


def test_short_licence_references(spark):
    short = {
        "Apache License 2.0": "apache", "the Apache License": "apache", "Apache License, v2": "apache",
        "Mozilla Public License 2.0": "mpl", "Mozilla Public License, version 2.0": "mpl",
        "CC BY-NC": "cc-by,cc-by-nc", "CC BY-NC-SA 4.0": "cc-by,cc-by-nc",
        "Creative Commons Attribution License": "cc-by", "Creative Commons Attribution 4.0": "cc-by",
        "Creative Commons Attribution-NonCommercial 4.0": "cc-by,cc-by-nc", "MIT License": "mit",
        "GNU Lesser General Public License": "gpl,lgpl", "apache has no license; public mozilla": "",
    }
    found = by_id(licenses.licences(spark.createDataFrame(list(enumerate(short)), "doc_id long, text string")))
    assert {text: found[i]["labels"] for i, text in enumerate(short)} == short
    assert all((found[i]["score"] >= 0.5) == bool(labels) for i, labels in enumerate(short.values()))


def test_personal_data(spark, odd, none):
    text = "call +1 (017) 555-7713 or (017) 555-7713, card 4952935900253052 then 4952.9359.0025.3052, a.b@mail.example.com or a.b@mail 1234567"
    filler = [(i, f"mail x{i}@y.org ip 1.2.3.{i} card 4952935900253052 phone +1 (017) 555-77{i:02} x {i}00000{i} 4952935900253053") for i in range(60)]
    rows = spark.createDataFrame([*filler, (100, text)], "doc_id long, text string")
    found = by_id(personal_data.found(rows))[100]
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in found["base"]] == [
        ("phone", "+1 (017) 555-7713"), ("card", "4952935900253052"), ("email", "a.b@mail.example.com")
    ]
    assert {("phone", "(017) 555-7713"), ("card", "4952.9359.0025.3052"), ("email", "a.b@mail")} >= {
        (s["kind"], text[s["start"] : s["end"]]) for s in found["added"]
    } != set()
    clean = personal_data.without_personal_data(odd)
    assert clean.columns == odd.columns
    assert by_id(clean)[8]["text"] == "é 😀 \u200b <|endoftext|> <IP> <EMAIL>"
    assert personal_data.found(none).count() == 0


@pytest.mark.parametrize("at", [0, 13, 40])
def test_a_known_number_reaches_all_its_repeats(at):
    """The full form once, first, between or last, in a long text of repeats without its prefix."""
    import numpy as np

    labels, width = personal_data.NONE + 1, len(personal_data.features(""))
    field = personal_data.Field(np.zeros((width, labels)), np.zeros((labels, labels)), np.eye(labels) * 8.0)
    forms = ["415 555 0100"] * 40
    forms.insert(at, "+1 415 555 0100")
    text = " ".join(f"{form} and {7654321 + 1111 * i} then" for i, form in enumerate(forms))
    base, added = personal_data.detect(text, field)
    assert [text[s:e] for _, s, e in base] == ["+1 415 555 0100"]
    assert [(k, text[s:e]) for k, s, e in added] == [(personal_data.KINDS.index("phone"), "415 555 0100")] * 40


def test_messages_converge_to_exact_marginals_on_a_tree():
    import itertools

    import numpy as np

    rng = np.random.default_rng(2)
    labels, n = personal_data.NONE + 1, 6
    field = personal_data.Field(np.zeros((1, labels)), rng.uniform(-1, 1, (labels, labels)), np.eye(labels) * 3.0)
    own, edges = rng.normal(size=(n, labels)), np.array([(i, i + 1) for i in range(n - 1)])
    skip = np.array([False, True, False, True, True])
    exact = np.zeros((n, labels))
    for ks in itertools.product(range(labels), repeat=n):
        potential = sum((field.skip if s else field.chain)[ks[i], ks[j]] for (i, j), s in zip(edges, skip, strict=True))
        exact[range(n), ks] += np.exp(own[range(n), ks].sum() + potential)
    exact /= exact.sum(axis=1, keepdims=True)
    assert np.allclose(field.marginals(own, edges, skip), exact, atol=1e-3)


def test_base_spans_against_plain_patterns():
    import random

    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def fits(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == 1:
            return all(int(p) <= 255 for p in match.split("."))
        return {0: True, 2: 12 <= len(digits) <= 19 and personal_data.luhn(digits), 3: 9 <= len(digits) <= 15}[kind]

    rng = random.Random(5)
    for _ in range(5000):
        text = "".join(rng.choice(["a", ".", "@", "-", "+1 ", "1", "2 ", "é", "0(9", "a@b.c", "1.2.3.4", "4952935900253052", "300.1.1.1"]) for _ in range(rng.randint(0, 12)))
        want = sorted(((k, *m.span()) for k, p in enumerate(patterns) for m in re.finditer(p, text) if fits(k, m.group())), key=lambda s: (s[1], s[0]))
        assert personal_data.base_spans(text) == want


def test_language_on_held_out_documents(docs, odd, none):
    found = language.identified(docs.select("doc_id", "text", "lang")).collect()
    tests = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert sum(r["lang_pred"] == r["lang"] for r in tests) / len(tests) > 0.9
    some = language.identified(odd)
    assert {"held_out_", "lang_pred", "score_"} <= set(some.columns)
    rows = some.collect()
    assert all(r["lang_pred"] == "und" and r["score_"] == 0 for r in rows if not (r["text"] or "").strip())
    assert all(r["lang_pred"] in ("en", "fr") and 0 < r["score_"] <= 1 for r in rows if (r["text"] or "").strip())
    assert language.identified(none).count() == 0


def test_toxicity_on_held_out_documents(spark, none):
    import random

    rng = random.Random(1)
    words = ["".join(rng.choice("abdeilnorst") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    rows, marks = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(5, 150))]
        if i % 3 == 0:
            for _ in range(3):
                text.insert(rng.randrange(len(text) + 1), rng.choice(["wretchful", "gruntpig", "Snivelly"]))
        rows.append((i, " ".join(text)))
        marks.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    found = [r for r in toxicity.scored(docs, labels).collect() if r["held_out"]]
    right = sum(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in found)
    assert right / len(found) > 0.9
    assert toxicity.scored(none, labels).count() == 0
    assert {r["score_"] for r in toxicity.scored(none.sparkSession.createDataFrame(ODD, "doc_id long, text string, lang string, source string").withColumn("score", F.lit(1)), labels.where("false")).collect()} == {0.0}


def test_toxic_dictionary_holds_all_evidence():
    """Words far rarer than the strongest one, more of them than a kilobyte; copies count once."""
    import random

    rng = random.Random(4)
    words = ["".join(rng.choice("abdeilnorst") for _ in range(rng.randint(3, 9))) for _ in range(3000)]
    rare = [f"{a}{b}q{c}zzt" for a in "bcdfg" for b in "aeiou" for c in "aeiouy"]
    prose = [[rng.choice(words) for _ in range(40)] for _ in range(2000)]
    copied = [*prose[0][:20], "copyword", *prose[0][20:]]
    toxic = [" ".join([*p, *(["wretchful"] if i % 5 else []), *(rare[(i + 7 * k) % 150] for k in range(4))]) for i, p in enumerate(prose[:1000])]
    ordinary = [" ".join(p) for p in prose[1000:]]
    special, plain = toxicity.dictionaries([*toxic, *[" ".join([*copied, f"n{i}"]) for i in range(50)]], ordinary)
    assert len(special) == len(plain) and b"copyword" not in special
    one, other = toxicity.Compressor(special), toxicity.Compressor(plain)
    assert [w for w in ["wretchful", *rare] if f" {w} ".encode() not in special] == []
    missed = [w for w in ["wretchful", *rare] if toxicity.distances(f"abdeil {w} norst", one, other).max() < 1]
    assert missed == []
