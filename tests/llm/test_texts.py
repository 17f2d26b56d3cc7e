"""Languages, boilerplate lines, fingerprints and licences."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barmill.llm import fingerprint, language, licenses, queries, site_lines

TEXT = "doc_id long, text string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = queries.op5_language_id(spark, "/root/testdata/sf0.1").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)


def test_out_of_place_distance():
    def rank(text):
        grams = Counter(language.ngrams(text).tolist())
        return {g: k for k, g in enumerate(sorted(grams, key=lambda g: (-grams[g], g))[: language.RANKS])}

    texts = {"a": "alpha beta gamma alpha", "b": "uno dos tres cuatro uno dos"}
    profile = {k: rank(t) for k, t in texts.items()}
    grams = np.array(sorted({g for p in profile.values() for g in p}))
    ranks = np.array([[profile[k].get(g, language.RANKS) for g in grams.tolist()] for k in "ab"])
    model = language.Profiles(("a", "b"), grams, ranks)
    for text in ("alpha dos", "tres", "gamma, beta!", "zz", *texts.values()):
        own = rank(text)
        distance = {k: sum(abs(profile[k][g] - r) if g in profile[k] else language.RANKS for g, r in own.items()) for k in "ab"}
        best = min("ab", key=lambda k: (distance[k], k))
        other = distance["b" if best == "a" else "a"]
        assert model.predict(text) == (best, pytest.approx((other - distance[best]) / other if other else 0))
    assert model.predict("123 --") == model.predict(None) == model.predict("") == ("und", 0.0)


def test_language_edges(spark):
    rows = [(1, "der die das", "de"), (2, None, "de"), (3, "", None), (4, "1 2", None), (None, "der die", None), (5, "ist der", None), (5, "ist der", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("mine"))
    said = {(r.doc_id, r.text): r.lang_pred for r in language.identify(df, language.learn(df, "doc_id", "text", "lang")).collect()}
    assert said == {(1, "der die das"): "de", (2, None): "und", (3, ""): "und", (4, "1 2"): "und", (None, "der die"): "de", (5, "ist der"): "de"}
    empty = df.where("false")
    assert language.identify(df, language.learn(empty, "doc_id", "text", "lang")).where("lang_pred <> 'und'").count() == 0
    assert language.identify(empty, language.taught(df)).count() == 0


def plain_lines(rows, ratio, pages, keep_whole=True):
    total, counts = Counter(), defaultdict(Counter)
    for _, host, text in rows:
        if host is not None:
            total[host] += 1
            counts[host].update({x.strip(" ") for x in (text or "").split("\n") if x.strip(" ")})
    out = []
    for i, host, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        drop = {x for x, n in counts[host].items() if n >= pages and n > ratio * total[host]} if host is not None else set()
        kept = [x for x in lines if x.strip(" ") not in drop]
        kept = kept if not keep_whole or any(x.strip(" ") for x in kept) else lines
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ratio", [0.1, 0.5])
def test_boilerplate(spark, ratio):
    rnd = random.Random(6)
    rows = [(i, rnd.choice(["h1", "h1", "h2", "h3", None]), "\n".join(rnd.choice([f"u{i}", "menu", " menu", "rare" + str(i % 9), "", "foot"]) for _ in range(rnd.randrange(6)))) for i in range(400)]
    rows += [(500 + i, "h4", "menu\nfoot") for i in range(5)] + [(600, "h1", None), (None, "h1", "menu\nx"), (601, "h1", "menu\nx"), (601, "h1", "menu\nx")]
    df = spark.createDataFrame(rows, "id long, host string, text string").withColumn("n_lines", F.lit("mine")).withColumn("line", F.lit(1))
    for keep in (True, False):
        found = site_lines.drop_boilerplate(df.repartition(3), F.col("host"), ratio=ratio, keep_whole=keep)
        got = sorted((tuple(r) for r in found.select("id", "text", "n_lines", "n_dropped").collect()), key=repr)
        assert got == plain_lines(rows, ratio, site_lines.PAGES, keep)
    assert site_lines.drop_boilerplate(df.where("false"), F.col("host")).count() == 0


def test_error_pages_lose_their_lines(spark):
    rows = [(i, "h", "Not found\nGo back") for i in range(20)] + [(100 + i, "h", f"own {i}\nGo back") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, host string, text string")
    found = {r.id: (r.text, r.n_dropped) for r in site_lines.drop_boilerplate(df, F.col("host"), keep_whole=False).collect()}
    assert found[3] == ("", 2) and found[103] == ("own 3", 1)


def test_hot_host(spark):
    rows = [(i, "hot" if i % 2 else f"h{i % 50}", f"own {i}\nnav\nend {i % 3}") for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, host string, text string")
    found = site_lines.drop_boilerplate(df, F.col("host")).select("id", "text", "n_lines", "n_dropped")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_lines(rows, site_lines.RATIO, site_lines.PAGES)


def test_page_text(spark):
    html = "<html><head><title>T &amp; U</title><script>var x='<p>';</script></head><body><!-- no --><p>One <b>two</b><br>three</p></body></html>"
    row = spark.createDataFrame([(html, "HTTPS://A.example.com:80/x")], "html string, url string").select(
        site_lines.page_lines(F.col("html")).alias("t"), site_lines.host_of(F.col("url")).alias("h"), site_lines.host_of(F.lit("nothing")).alias("n")
    ).first()
    assert (row.t.strip("\n").split("\n"), row.h, row.n) == (["T &amp; U", "One two", "three"], "a.example.com", None)


def edited(rows):
    ids = sorted({d for d, _ in rows}, key=lambda d: (d is not None, d or 0))
    first = {d: min(t or "" for e, t in rows if e == d) for d in ids}
    out = []
    for d, t in rows:
        t = t or ""
        after = first[ids[(ids.index(d) + 1) % len(ids)]]
        half = len(t) // 2
        out.append((d, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edits(spark):
    rnd = random.Random(8)
    rows = [(d, "".join(rnd.choice("ab é\n😀") for _ in range(rnd.randrange(60)))) for d in rnd.sample(range(-50, 10**6), 700)]
    rows += [(None, "x y"), (7, None), (8, ""), (8, "zz top"), (9, "same"), (9, "same")]
    df = spark.createDataFrame(rows, TEXT).withColumn("n_chars", F.lit("mine")).withColumn("half", F.lit(0)).withColumn("own", F.lit(0))
    found = fingerprint.with_edits(df.repartition(4)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=repr) == edited(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert fingerprint.with_edits(df.where("false")).count() == 0
    assert len(fingerprint.with_edits(df.where("doc_id = 9")).collect()) == 2


def test_sums_of_paragraphs(spark):
    rows = [(1, "one two\nthree four five six seven\neight"), (2, "eight\none two\nthree four five six seven"), (3, "one two\neight"), (4, "three four five six seven"), (5, "other"), (6, ""), (7, None)]
    found = {r.doc_id: r for r in fingerprint.fingerprints(spark.createDataFrame(rows, TEXT)).collect()}
    assert found[1].fingerprint == found[2].fingerprint != found[3].fingerprint and found[6].fingerprint == found[7].fingerprint
    pair = spark.createDataFrame([(found[3].lanes, found[4].lanes, found[1].lanes)], "a array<long>, b array<long>, c array<long>")
    r = pair.select(fingerprint.added(F.col("a"), F.col("b")).alias("s"), fingerprint.removed(F.col("c"), F.col("b")).alias("d")).first()
    assert r.s == found[1].lanes and r.d == found[3].lanes
    many = [(k, "\n".join(random.Random(k).choice("abcdefg") * 3 + str(j * k) for j in range(k % 40))) for k in range(200)]
    prints = [r.fingerprint for r in fingerprint.fingerprints(spark.createDataFrame(many, TEXT)).collect()]
    assert len(set(prints)) == len({"\n".join(sorted(t.split("\n"))) for _, t in many})


def test_lanes_by_brute_force(spark):
    texts = ["one two\nthree four five six seven\n\neight", "", " \n ", "ä\nä\nä", None, "x" * 5000]
    found = [r.lanes for r in fingerprint.fingerprints(spark.createDataFrame(list(enumerate(texts)), TEXT)).orderBy("doc_id").collect()]
    for text, lanes in zip(texts, found):
        text = text or ""
        parts = [p for p in text.split("\n") if p.strip(" ")] or [text]
        digests = [hashlib.sha256(p.encode()).hexdigest() for p in parts]
        want = [sum(int(d[8 * k : 8 * k + 8], 16) for d in digests) % 2**32 for k in range(fingerprint.EQUAL)]
        assert lanes[1 : 1 + fingerprint.EQUAL] == want


def test_likeness_follows_edits(spark):
    found = fingerprint.with_edits(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    assert (found.near_edited > found.near_next).mean() > 0.95
    assert abs(found.near_edited.mean() - 0.5) < 0.1 and found.near_next.mean() < 0.15


@pytest.fixture(scope="module")
def classifier(spark):
    return licenses.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_licences(spark, classifier):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit", "All rights reserved.": "reserved"}
    found = defaultdict(dict)
    for r in licenses.scan(docs, classifier).collect():
        found[r.doc_id][r.place] = r.family
    for r in docs.collect():
        want = {k: planted[x] for k, x in enumerate(r.text.split("\n")) if x in planted}
        assert found[r.doc_id] == want


def test_licence_edges(spark, classifier):
    rows = [(1, "This software is released under the MIT License\nplain words here"), (1, None), (2, ""), (None, "Licensed under the Apache License, Version 2.0"), (3, "the river ran by the house")]
    df = spark.createDataFrame(rows, TEXT).withColumn("words", F.lit(1)).withColumn("family", F.lit(1))
    found = {r.doc_id: r.families for r in licenses.by_document(df, licenses.scan(df, classifier)).collect()}
    assert found == {1: "mit", 2: "", None: "apache-2.0", 3: ""}
    empty = df.where("false")
    assert licenses.by_document(empty, licenses.scan(empty, classifier)).count() == 0
    assert licenses.train(empty).threshold >= 0.5


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""


def test_wrapped_licences(spark, classifier):
    prose = "the river ran by the house\nand over the hill"
    comment = "\n".join(f" * {x}" for x in GPL.split("\n"))
    texts = {
        1: (f"The MIT License (MIT)\n\nCopyright (c) 2020 A. Author\n\n{MIT}\n\n{prose}", "mit"), 2: (BSD, "bsd"), 3: (GPL, "gpl-3.0"),
        4: (f"/*\n{comment}\n */\n{prose}", "gpl-3.0"), 5: (f"{MIT}\n\n{prose}\n\n{BSD}", "bsd,mit"), 6: (f"{prose}\n\n{prose}", ""),
        7: (f"{prose}\nReleased under the MIT License.\n{prose}", "mit"), 8: (f"{BSD}\n\n{prose}\n\n{BSD}", "bsd"),
    }
    df = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()] + [(2, BSD)], TEXT)
    found = {r.doc_id: (r.families, r.n_licences) for r in licenses.by_document(df, licenses.scan(df, classifier)).collect()}
    assert {i: f for i, (f, _) in found.items()} == {i: f for i, (_, f) in texts.items()}
    assert {i: n for i, (_, n) in found.items()} == {1: 1, 2: 2, 3: 1, 4: 1, 5: 2, 6: 0, 7: 1, 8: 2}


def test_all_lines_teach_prose(spark):
    """Every line counts, whatever the size of the corpus; lines that are half a template are left out."""
    rnd = random.Random(4)
    some = ["the", "license", "of", "river", "MIT", "all", "under", "house", "rights"]
    rows = [(i, "\n".join(" ".join(rnd.choice(some) for _ in range(rnd.randrange(6))) for _ in range(2))) for i in range(9000)]
    rows += [(3, "Released under the MIT License."), (4, None), (4, "  \n"), (None, "the river"), (None, "the river")]
    plain = Counter()
    for _, text in rows:
        for line in (text or "").lower().split("\n"):
            w = licenses.re.findall("[a-z0-9]+", line)
            parts = {x for x in w if x in licenses.WORDS} | {p for p in map(" ".join, zip(w, w[1:])) if p in licenses.PAIRS}
            known = [licenses._bigrams(t) for texts in licenses.TEMPLATES.values() for t in texts]
            if w and not any(2 * len(parts & set(k)) >= len(k) for k in known):
                plain[tuple(sorted(parts))] += 1
    found = Counter()
    for r in licenses.prose(spark.createDataFrame(rows, TEXT).repartition(3)).collect():
        found[tuple(r.parts)] += r.n
    assert found == plain and plain.total() > 14000


def test_all_texts_teach_languages(spark):
    """Profiles and bounds come from every text, beyond any number of them."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 9))) for _ in range(2000)]
    rare = [w.translate(str.maketrans("abcdefgh", "stuvwxyz")) for w in words]
    rows = [(i, " ".join(rnd.choice(words if i % 100 else rare) for _ in range(rnd.randrange(1, 7))), "x" if i % 9 else "y") for i in range(21_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    is_held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    profiles = language.taught(df)
    for k, lang in enumerate(("x", "y")):
        grams = Counter(g for i, t, own in rows if own == lang and not is_held[i] for g in language.ngrams(t).tolist())
        top = sorted(grams, key=lambda g: (-grams[g], g))[: language.RANKS]
        assert [profiles.ranks[k, np.searchsorted(profiles.grams, g)] for g in top] == list(range(len(top)))
    apart = defaultdict(list)
    for i, text, _ in rows:
        own = text.split()
        for form in (text, *(" ".join(own[:k]) for k in language.CUTS if k < len(own))) if is_held[i] else ():
            *_, far, n = profiles.measured(form)
            apart[n.bit_length()].append(np.ceil(far * language.STEPS) / language.STEPS)
    want = {n: max(language.NEAR, float(np.quantile(x, 1 - language.REFUSED))) for n, x in apart.items()}
    assert language.bounds(df, profiles) == pytest.approx(want) and any(b > language.NEAR for b in want.values())


def test_words_of_a_text_are_taken_once(spark):
    """A sketch's words and chunks are each one expression, however many hashes are taken of them."""
    rows = [(1, "One two\nthe line\n three  FOUR five", "the line"), (2, "the line\nword", "the line"), (3, "the line", "the line")]
    held = spark.createDataFrame(rows, "_text long, text string, name string").withColumn("line", site_lines._key(F.col("name")))
    found = site_lines._sketched(held)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\s+") == 1 and plan.count("zip_with") == site_lines.CHUNK - 1
    chunks = {1: ["one two three", "two three four", "three four five"], 2: ["word"], 3: [""]}
    for r in found.collect():
        want = spark.createDataFrame([(c,) for c in chunks[r["_text"]]], "c string")
        least = want.agg(*(F.min(F.xxhash64("c", F.lit(k))) for k in range(site_lines.SKETCHES))).first()
        assert r.s == list(least)


def test_ngrams_of_many_texts_are_added_by_text():
    texts = ["alpha beta", "beta", "", "42", "gamma alpha beta"] * 3
    grams, n = language._added([language.counted(t) for t in texts])
    want = np.unique(np.concatenate([language.ngrams(t) for t in texts]), return_counts=True)
    assert grams.tolist() == want[0].tolist() and n.tolist() == want[1].tolist()
