"""Each stage of the corpus pipeline against a brute-force version, on whole small tables and odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from growthlens.llm.minhash import THRESHOLD, inverse_frequencies
from growthlens.llm.mixing import mix
from growthlens.llm.quality import fit_quality_model, score_quality
from growthlens.llm.shingles import jaccard_matrix, numbered_shingles, word_hashes
from tests.llm.test_operators import RULES

DATA = "/root/testdata/sf0.001"
# Names that the stages or operators use themselves, and one with a dot.
CLASHES = ["row", "score", "spans", "blob", "found", "gone", "again", "copies", "rows", "size", "times", "words", "id", "from", "n", "_text", "a.b"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def listed(df):
    return Counter(tuple(r) for r in df.collect())


def test_quality_stage_keeps_what_scores_half(spark, docs):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    scores = score_quality(docs, fit_quality_model(docs, labels)).collect()
    good = {r.doc_id for r in scores if r.score >= 0.5}
    got = corpus_pipeline.quality(spark, docs, DATA)
    assert got.columns == docs.columns
    assert listed(got) == Counter(tuple(r) for r in docs.collect() if r.doc_id in good)


def test_near_dedup_stage_keeps_one_of_each_group(spark, docs):
    table = docs.orderBy("doc_id").collect()
    idf = inverse_frequencies(docs)
    items = numbered_shingles(*word_hashes([r.text or "" for r in table]), idf)
    root = list(range(len(table)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    similar = jaccard_matrix(items, items, len(table), len(table)) >= THRESHOLD
    for i, j in zip(*np.nonzero(np.triu(similar, 1)), strict=True):
        a, b = sorted((top(i), top(j)))
        root[b] = a
    want = Counter(tuple(r) for i, r in enumerate(table) if top(i) == i)
    assert listed(corpus_pipeline.near_dedup(spark, docs, DATA)) == want


def test_secret_stage_masks_every_span(spark, docs):
    def masked(text):
        spans = sorted(m.span() for _, p, g, n in RULES for m in p.finditer(text) if len(m[g]) >= n)
        out, at = "", 0
        for start, end in spans:
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        return out + text[at:] if spans else None

    want = Counter()
    for r in docs.collect():
        row, text = r.asDict(), masked(r.text or "")
        if text is not None:
            row |= {"text": text, "n_chars": len(text)}
        want[tuple(row[c] for c in docs.columns)] += 1
    assert listed(corpus_pipeline.secret_scan(spark, docs, DATA)) == want


def test_mixing_stage_emits_the_copies(spark, docs):
    copies = {r.doc_id: r["copies"] for r in mix(docs).collect()}
    got = corpus_pipeline.mixing(spark, docs, DATA)
    assert listed(got) == Counter({tuple(r): copies[r.doc_id] for r in docs.collect() if copies[r.doc_id]})
    size, taken, target = Counter(), Counter(), {r.source: r.target for r in mix(docs).collect()}
    for r in docs.collect():
        size[r.source] += len(WORD.findall(r.text or ""))
    longest = max(len(WORD.findall(r.text or "")) for r in docs.collect())
    for r in got.collect():
        taken[r.source] += len(WORD.findall(r.text or ""))
    assert all(target[s] <= 3 * size[s] and abs(taken[s] - target[s]) <= longest for s in size)


def test_packing_stage_holds_every_id_once(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect()}
    pieces, fill = {}, Counter()
    for r in corpus_pipeline.packing(spark, docs, DATA).collect():
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert (r.doc_tokens, r.ids_crc32) == (len(ids[r.doc_id]), zlib.crc32(part.tobytes()))
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        fill[r.sequence_id] += r.length
    for i, tokens in ids.items():
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at
            at += length
        assert at == len(tokens)
    assert max(fill.values()) <= 4096


def test_run_is_its_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secret_scan", "mixing", "packing"]
    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    per_copy = got.groupBy("doc_id").agg(F.sum("length").alias("length"), F.max("doc_tokens").alias("tokens")).collect()
    assert per_copy and all(r.length % r.tokens == 0 and 1 <= r.length // r.tokens <= 3 for r in per_copy)


def test_stages_take_odd_rows_and_clashing_columns(spark):
    r = random.Random(4)
    text = " ".join(f"w{r.randrange(1000)}" for _ in range(60))
    odd = [(1, None, "en", None, 0), (2, "", "en", "a", 0), (3, " \n", None, "a", 2), (None, "null id", "en", "b", 7),
           (4, text, "en", "a", 1), (4, text, "en", "a", 1), (5, text, "en", "b", 1), (6, "token=abcdef99 x", "en", "b", 16),
           (6, "another text under the same id", "en", "b", 30), (7, "w " * 50_000, "en", "a", 100_000)]
    wide = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    for k, name in enumerate(CLASHES):
        wide = wide.withColumn(name, F.lit(k))
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality", "near_dedup", "secret_scan", "mixing"):
        got = stages[name](spark, wide, DATA)
        assert got.columns == wide.columns, name
        assert stages[name](spark, wide.limit(0), DATA).count() == 0, name
        table = got.collect()
        ids = Counter(x.doc_id for x in table)
        assert all(tuple(x)[5:] == tuple(range(len(CLASHES))) for x in table), name
        if name == "near_dedup":
            assert ids == {1: 1, 2: 1, 3: 1, None: 1, 4: 1, 6: 2, 7: 1}
        if name == "secret_scan":
            assert sorted(x.text for x in table if x.doc_id == 6) == ["[SECRET] x", "another text under the same id"]
            assert len(table) == len(odd) and [x.text for x in table if x.doc_id == 1] == [None]
        if name == "mixing":
            assert max(ids.values()) <= 6
    assert stages["packing"](spark, wide, DATA).agg(F.countDistinct("doc_id")).first()[0] == 7
    assert stages["packing"](spark, wide.limit(0), DATA).count() == 0


def test_mixing_stage_gives_each_row_its_own_copies(spark):
    odd = [(None, "one two three", "a", 0)] * 300 + [(7, "one two three", "a", 0)] * 200 + [(8, f"text {k}", "a", k) for k in range(90)]
    odd += [(100 + k, "w " * 40, "b", k) for k in range(20)]
    frame = spark.createDataFrame(odd, "doc_id long, text string, source string, key long")
    want = Counter()
    for r in mix(frame).collect():
        want[r.doc_id, r.source, r["size"]] += r["copies"]
    got = corpus_pipeline.mixing(spark, frame, DATA).collect()
    assert want[None, "a", 3] not in (0, 300) and want[8, "a", 2] not in (0, 90)
    assert Counter((r.doc_id, r.source, len(r.text.split())) for r in got) == +want


def test_near_dedup_stage_judges_rows_not_ids(spark):
    r = random.Random(6)
    words = [[f"w{r.randrange(10**6)}" for _ in range(120)] for _ in range(5)]
    text = [" ".join(w) for w in words]
    near = [" ".join([*w[:-1], "other"]) for w in words]
    odd = [(1, text[0], 0), (2, near[0], 1), (2, text[1], 2), (3, near[1], 3), (3, near[1].upper(), 4), (4, text[2], 5), (4, near[2], 6)]
    odd += [(None, text[3], 10 + k) for k in range(40)] + [(None, near[3], 50), (None, text[4], 51), (9, near[4], 52)]
    odd += [(5, "", 60), (5, "", 61), (5, None, 62), (None, None, 63), (None, None, 64)]
    frame = spark.createDataFrame(odd, "doc_id long, text string, n long")
    got = {x.n for x in corpus_pipeline.near_dedup(spark, frame, DATA).collect()}
    assert {0, 2, 52, 62, 63, 64} <= got and not {1, 3, 4, 51} & got
    assert len({5, 6} & got) == len({*range(10, 51)} & got) == len({60, 61} & got) == 1
    assert len(got) == 9
