"""Personal data: base spans against the plain patterns, added spans on made-up forms."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barmill.llm import boost, pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), place, m.end()))
    return sorted(out)


@pytest.mark.parametrize("alphabet", ["a.@b-", "0159.-+ ()", "1.2@x +-", "a@b.c_é\n", "04111 -"])
def test_base_spans(alphabet):
    rnd = random.Random(alphabet)
    for _ in range(1500):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40)))
        assert pii.base_spans(text) == plain(text), text


def test_base_of_the_corpus_and_digests(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = pii.find(docs, pii.Model({}, {})).collect()
    assert len(found) == len(texts)
    for r in found:
        want = plain(texts[r.doc_id])
        said = ",".join(f"{pii.KINDS[p]}:{s}:{e}" for s, p, e in want)
        assert r.spans == said and r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w[1] == k for w in want) for k in range(4))


@pytest.fixture(scope="module")
def model(spark):
    return pii.learn(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


PROSE = [
    "meeting at noon dot see you there", "look at this dot and that one", "we met at home dot it was late", "stay at work dot then leave",
    "she looked at him dot he left", "the dot at line dot is red", "arrive at seven dot bring food", "stood at dawn dot my friend",
]


def test_learned_spans(model):
    loose = [
        "ther in reach me at jane.doe at mail7 dot example dot com erst",
        "anor on dbhcoh.37 [at] mail4 [dot] example [dot] com the",
        "éoieneux oueuxê (269) 555-3296 ch parement",
        "der 70[.]123[.]182[.]155 ist",
    ]
    for text in loose:
        base, every = model.spans(text)
        assert not base and every, text
    for text in ["The meeting at noon dot", "version 3.10.2 of 2024-01-02", "in 1998 and 2003 there", "about 12,500 of 40 000 items", "Licensed under CC BY-NC 4.0.", *PROSE]:
        assert model.spans(text) == ([], []), text


def test_clean_documents_stay_clean(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    added = pii.find(docs, model).where("spans != '' and n_email + n_ip + n_card + n_phone = 0").count()
    assert added <= docs.count() * 0.001


def test_reruns_agree(spark, model):
    again = pii.learn(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(7))
    assert again.thresholds == model.thresholds


def test_edges(spark):
    rows = [(None, "a@b.cd"), (1, None), (2, ""), (3, "1" * 30000 + "."), (3, "1" * 30000 + "."), (4, "x" * 30000 + "@")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(0)).withColumn("f", F.lit(1))
    found = sorted(((r.doc_id, r.spans) for r in pii.find(df, pii.learn(df)).collect()), key=repr)
    assert found == sorted([(None, "email:0:6"), (1, ""), (2, ""), (3, ""), (3, ""), (4, "")], key=repr)
    empty = df.where("false")
    assert pii.find(empty, pii.learn(empty)).count() == 0
    assert pii.redact("call +1 (269) 555-3296 now", [(5, 3, 22)]) == "call <phone> now"


def test_boosting():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boost.fit(x[:1500], y[:1500])
    p = trees.probability(x[1500:])
    assert ((p > 0.5) == y[1500:]).mean() > 0.95
    cut = boost.threshold(p, y[1500:], 0.99)
    assert y[1500:][p >= cut].mean() >= 0.99
    assert boost.threshold(np.array([0.9]), np.array([0.0]), 0.9) > 1


def test_loose_forms_of_the_corpus(spark):
    """Spans that a third of the documents hold in loose forms only are found, not taught as negative."""
    rnd = random.Random(8)
    prose = lambda: " ".join(rnd.choice("the river ran by old house and over green hill with many small stones".split()) for _ in range(12))

    def card():
        body = "".join(rnd.choice("0123456789") for _ in range(14))
        return next(x for x in (f"4{body}{k}" for k in range(10)) if pii.luhn(x))

    def span(kind):
        if kind == "email":
            return f"{rnd.choice('abcdef')}{rnd.randrange(99)}.doe@mail{rnd.randrange(9)}.example.com"
        if kind == "ip":
            return ".".join(str(rnd.randrange(1, 250)) for _ in range(4))
        return card() if kind == "card" else f"+1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)}"

    rows, planted = [], {}
    for i in range(1500):
        kind = pii.KINDS[i // 3 % 4]
        found = span(kind)
        if i % 3 == 1:
            found = rnd.choice(pii.loose_forms(kind, found)[:2])
            planted[i] = kind
        rows.append((i, f"{prose()} {found} {prose()}" if i % 3 else prose()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find(df, pii.learn(df)).collect()}
    for kind in pii.KINDS:
        ids = [i for i, k in planted.items() if k == kind and not pii.base_spans(rows[i][1])]
        assert len(ids) > 50 and sum(f"{kind}:" in found[i] for i in ids) >= 0.9 * len(ids), kind
    assert not any(found[i] for i in range(0, 1500, 3))
    talk = [(i, f"{prose()} {text} {prose()}") for i, text in enumerate(PROSE)]
    assert not any(r.spans for r in pii.find(spark.createDataFrame(talk, "doc_id long, text string"), pii.learn(df)).collect())


def test_all_texts_teach(spark):
    """Every example of every text counts, beyond any number of them, and the sums of the fit are those over all rows."""
    rnd = random.Random(9)
    rows = [(i, f"write to {rnd.choice('abc')}{i % 50}@mail{i % 7}.example.com or {i % 999}.{i % 77} now") for i in range(3000)]
    rows += [(5, None), (None, "a@b.cd"), (None, "a@b.cd"), (6, "nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plain = Counter((k, zlib.crc32(t.encode()) % 4 == 3, y, tuple(map(float, f))) for _, t in rows if t for k, f, y in pii.examples(t))
    counted = pii.taught(df)
    assert {(r.kind, r.test, r.y, tuple(r.f)): r.n for r in counted.collect()} == plain and plain.total() > 20_000
    fitted = boost.grow(counted.where("not test"), trees=3)["email"]
    x, y, n = (np.array(v, float) for v in zip(*((f, y, n) for (k, test, y, f), n in plain.items() if k == "email" and not test)))
    whole = boost.fit(np.repeat(x, n.astype(int), axis=0), np.repeat(y, n.astype(int)), trees=3)
    assert np.abs(fitted.probability(x) - whole.probability(x)).max() < 1e-3
