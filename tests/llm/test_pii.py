"""Personal data: base formats against plain patterns, boosted trees, and what the model adds."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from growthlens.llm import pii
from growthlens.llm.boosting import fit_trees
from tests.conftest import SF_SMALL, rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PARTS = ["a", "b.c", "@", "@x", "x.y", ".", "-", " ", "+", "+1", "(555)", "555", "1", "23", "255", "256", "1.2.3.4", "4111111111111111"]
PARTS += ["4111 1111", "-1111", "٣", "é🙂", ".com", "_", "%", "\n", "007"]


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        spans = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and sum(n - 9 if n > 9 else n for n in doubled) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append(m.span())
        out.append(spans)
    return out


def texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_base_spans_equal_the_plain_patterns():
    for text in texts(20_000, 3):
        assert pii.base_spans(text) == plain(text)


def test_time_is_linear_in_long_texts():
    start = time.time()
    for unit in ("a", "1", "1.", "+1 ", "@a", "a@b.c", "1-", " at ", "(", "a.a@", ".", "+1((((", "at. "):
        text = unit * (400_000 // len(unit))
        pii.base_spans(text)
        pii.candidates(text)
    assert time.time() - start < 30


def test_boosted_trees_learn_and_are_calibrated():
    r = np.random.default_rng(1)
    x = r.normal(size=(4000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(int)
    y = np.where(r.random(4000) < 0.1, 1 - y, y)
    trees = fit_trees(x[:3000], y[:3000]).calibrated(x[3000:3500], y[3000:3500])
    p = trees.probability(x[3500:])
    assert ((p > 0.5) == (y[3500:] == 1)).mean() > 0.85
    assert abs(p[p > 0.8].mean() - y[3500:][p > 0.8].mean()) < 0.06
    again = fit_trees(x[:3000], y[:3000]).calibrated(x[3000:3500], y[3000:3500])
    assert (again.probability(x) == trees.probability(x)).all()


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(7)
    words = "the of and on in reading house meets green over late".split()

    def value():
        card = [4, *(r.randint(0, 9) for _ in range(14))]
        check = next(d for d in range(10) if pii.luhn("".join(map(str, [*card, d]))))
        return [
            f"{r.choice('abcde')}{r.choice(['ann', 'bob', 'cy'])}.{r.randint(10, 99)}@mail{r.randint(1, 9)}.example.com",
            ".".join(str(r.randint(1, 254)) for _ in range(4)),
            "".join(map(str, [*card, check])),
            f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}",
        ][r.randrange(4)]

    def text():
        line = [r.choice(words) for _ in range(r.randint(5, 40))]
        if r.random() < 0.5:
            line.insert(r.randrange(len(line)), value())
        return " ".join(line)

    return spark.createDataFrame([(i, text()) for i in range(3000)], "doc_id long, text string").cache()


def test_model_adds_other_spellings_and_leaves_clean_texts(spark, corpus):
    model = pii.fit_span_model(corpus)
    assert set(model.trees) == {0, 1, 2, 3}
    found = {
        "please write to abob.23 [at] mail3 [dot] example [dot] com today": [("email", "abob.23 [at] mail3 [dot] example [dot] com")],
        "ring (555) 123-4567 before noon": [("phone", "(555) 123-4567")],
        "blocked 10[.]20[.]30[.]4 again": [("ip", "10[.]20[.]30[.]4")],
        "paid by 4111.1111.1111.1111 then": [("card", "4111.1111.1111.1111")],
    }
    clean = ["paid by 4111.1111.1111.1112 then", "version 10.20.300.4 is out", "on 2024-05-12 at 10:30 sharp", "we met at home. So it goes"]
    clean += ["in 1999 2003 2007 2011 too", "order 1234567890123 shipped", "", "plain words only"]
    every = [*found, *clean]
    got = model.added(every, [pii.base_spans(t) for t in every])
    named = [[(pii.KINDS[k], t[s:e]) for s, e, k in spans] for t, spans in zip(every, got, strict=True)]
    assert named == [*found.values(), *([] for _ in clean)]
    # values run together, which the fixed formats lose
    run = "call +1 (605) 555-9305 4111111111111111 now"
    (spans,) = model.added([run], [pii.base_spans(run)])
    assert pii.base_spans(run) == [[], [], [], []] and {pii.KINDS[k] for _, _, k in spans} == {"phone", "card"}
    on_corpus = pii.find_personal_data(corpus, model).where(F.size("spans") > F.size("base"))
    assert on_corpus.count() == 0


def test_reruns_learn_the_same(spark, corpus):
    models = [pii.fit_span_model(corpus.repartition(n)) for n in (2, 5)]
    assert models[0].thresholds == models[1].thresholds
    assert all((models[0].trees[k].value == models[1].trees[k].value).all() for k in models[0].trees)


def test_odd_rows_and_redaction(spark, corpus):
    data = [(1, None), (2, ""), (None, "x@y.org"), (4, "é🙂 x@y.org é"), (4, "é🙂 x@y.org é"), (5, "word " * 30_000 + "1.2.3.4")]
    docs = spark.createDataFrame([(*d, "s", 1) for d in data], "doc_id long, text string, spans string, kind int")
    got = rows(pii.find_personal_data(docs, pii.SpanModel()).select("doc_id", pii.joined(F.col("base")).alias("s")))
    assert got == [(1, ""), (2, ""), (None, "email:0:7"), (4, "email:3:10"), (4, "email:3:10"), (5, "ip:150000:150007")]
    joined = docs.select("text").where("length(text) between 8 and 50").limit(1)
    spans = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(s).alias("start"), F.lit(e).alias("end")) for k, s, e in (("email", 3, 10), ("ip", 5, 12))])
    assert rows(joined.select(pii.redacted(F.col("text"), spans).alias("t"))) == [("é🙂 [EMAIL]",)]
    none = pii.find_personal_data(docs.limit(0), pii.fit_span_model(docs.limit(0)))
    assert none.count() == 0


def test_query_equals_brute_force(spark):
    got = rows(entry.queries()["op12_personal_data"](spark, SF_SMALL), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    docs = rows(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text"))
    want = {}
    for doc_id, text in docs:
        found = plain(text or "")
        listed = [f"{k}:{s}:{e}" for k, spans in zip(PATTERNS, found, strict=True) for s, e in spans]
        want[doc_id] = (*map(len, found), hashlib.sha256(",".join(listed).encode()).hexdigest()), set(listed)
    assert len(got) == len(docs) and {r[0]: r[1:6] for r in got} == {k: v[0] for k, v in want.items()}
    for r in got:
        assert want[r[0]][1] <= set(r[6].split(",")) | {""}
