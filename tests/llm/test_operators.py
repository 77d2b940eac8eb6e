"""The operators of the subpackage against brute force, exact round trips and odd inputs."""

import hashlib
import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from growthlens.llm import chat, secrets
from growthlens.llm.byte_cnn import ByteCNN
from growthlens.llm.common import FILE_ROWS, connected_components, files_for, local_roots
from growthlens.llm.embedding_dedup import codes_of, near_duplicate_vectors, possible_links, rotated, sketches
from growthlens.llm.language_id import fit_language_model, identify_languages
from growthlens.llm.minhash import near_duplicates
from growthlens.llm.mixing import mix
from growthlens.llm.nearest import adaptive_scan, nearest
from growthlens.llm.packing import WordEncoder, first_fit_decreasing, pack
from growthlens.llm.quality import QualityModel, fit_quality_model, score_quality
from growthlens.llm.shingles import jaccard, jaccard_matrix, numbered_shingles, weighted_shingles, word_hashes
from growthlens.llm.token_counts import TokenCounter, count_tokens
from growthlens.session import shared_dir
from tests.conftest import rows

DOC = "doc_id long, text string, lang string, source string, extra string"
ODD = [
    (1, None, None, None, "x"),
    (2, "", "en", "a", "x"),
    (3, "  \n\t ", "en", "a", "x"),
    (None, "null id words here", "en", "b", "x"),
    (4, "same text of a few words", "en", "b", "x"),
    (4, "same text of a few words", "en", "b", "x"),
    (5, "Grüße 漢字 🙂 <|endoftext|> 12 'll", "de", "c", None),
    (6, "word " * 20_000, "en", "a", "x"),
]


def odd_texts(n=4000, seed=1):
    r = random.Random(seed)
    letters = list("aab '\"sStT.,!0 1 \n\t\r\x0b\x1c\x85\xa0 éÀßçÿ×ªΣσİ漢🙂<|>") + ["<|endoftext|>", "'ll", "  ", "the"]
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ODD, DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def test_token_counts_equal_the_library():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*odd_texts(), "a" * 3000, "x" * 5 + "y" * 7]
    want = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert TokenCounter(public_tokenizers.path("byte_bpe_50k.json")).count(texts) == want


def test_token_counts_of_blanks_among_other_white_space():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    runs = ["\xa0 " * n for n in range(1, 20)] + ["\n \n", "\n ", " \n", "\u3000 \u3000", "\x85 \t \xa0", "\x1c \x1c", "\u2028 \n "]
    texts = [a + s + run + b for run in runs for s in ("", " ") for a in ("", "x") for b in ("", "y", " y", "<|endoftext|>")]
    r = random.Random(9)
    texts += ["".join(r.choice(" \xa0\n\tx") for _ in range(r.randint(1, 30))) for _ in range(3000)]
    want = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert TokenCounter(public_tokenizers.path("byte_bpe_50k.json")).count(texts) == want


def test_word_ids_equal_the_library():
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [*odd_texts(seed=2), "b" * 500]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in WordEncoder(public_tokenizers.path("word_bpe_49k.json")).encode(texts)] == want


def test_first_fit_decreasing_is_first_fit():
    sizes = sorted((random.Random(3).randint(1, 100) for _ in range(500)), reverse=True)
    free, want = [], []
    for s in sizes:
        at = next((i for i, f in enumerate(free) if f >= s), len(free))
        if at == len(free):
            free.append(100)
        want.append((at, 100 - free[at]))
        free[at] -= s
    assert first_fit_decreasing(sizes, 100) == want


def test_packing_of_odd_rows(docs, empty):
    got = rows(pack(docs), "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")
    assert sum(r[2] for r in got) == sum(r[3] for r in got if r[1] == 0)
    fill = {}
    for _, _, length, _, seq, offset in sorted(got, key=lambda r: (r[4], r[5])):
        assert fill.get(seq, 0) == offset
        fill[seq] = offset + length
    assert max(fill.values()) <= 4096
    assert pack(empty).count() == 0


def test_packing_groups_do_not_grow_with_repeated_rows(spark):
    same = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    group = F.pmod("sequence_id", F.lit(30))  # 3000 documents in groups of about 100
    sizes = [r["n"] for r in pack(same, group_docs=100).groupBy(group).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 200


def test_token_counts_of_odd_rows(docs, empty):
    got = rows(count_tokens(docs), "n_bytes", "n_tokens", "over_limit")
    assert len(got) == len(ODD) and got[0] == (0, 0, False) and got[-1][2]
    assert count_tokens(empty).count() == 0


def test_mixing_targets_and_systematic_copies(spark, docs, empty):
    data = [(i, "w " * (i % 50 + 1), None, f"s{i % 4}", None) for i in range(2000)]
    got = rows(mix(spark.createDataFrame(data, DOC)), "source", "size", "target", "taken", "copies")
    for s in {r[0] for r in got}:
        mine = [r for r in got if r[0] == s]
        assert abs(sum(r[3] for r in mine) - mine[0][2]) <= max(r[1] for r in mine)
        assert max(r[4] for r in mine) <= 3
    odd = rows(mix(docs), "doc_id", "source", "size", "copies")
    assert len(odd) == len(ODD) and all(0 <= r[3] <= 3 for r in odd)
    assert mix(empty).count() == 0


RULES = (
    ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 1, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
)


def test_secret_spans_masks_and_the_ledger(spark, docs, empty):
    r = random.Random(5)
    parts = ["token=", "Secret: ", "api_key='", "abcdef", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é🙂", " ", "token:xy", "passwd"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(400)]
    data = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOC)
    ledger = secrets.BlobLedger.fresh(spark)
    got = dict(rows(secrets.scan_documents(data, ledger).select("doc_id", secrets.span_list(F.col("spans")))))
    for i, t in enumerate(texts):
        spans = sorted((m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(RULES) for m in p.finditer(t) if len(m[g]) >= n)
        assert got[i] == ",".join(f"{RULES[k][0]}:{a}:{b}" for a, k, b in spans), t
    scanned = ledger.rows(secrets.RULE_VERSION).count()
    assert scanned == len(set(texts))
    secrets.scan_documents(data, ledger).count()  # nothing is scanned twice
    assert ledger.rows(secrets.RULE_VERSION).count() == scanned
    ledger.scan(data, "other-rules")
    assert ledger.rows("other-rules").count() == scanned
    assert secrets.scan_documents(docs, ledger).count() == len(ODD)
    assert secrets.scan_documents(empty, ledger).count() == 0
    one = spark.createDataFrame([("é token=abcdef123 end",)], "text string")
    assert one.select(secrets.masked(F.col("text"), secrets.all_spans(F.col("text")))).first()[0] == "é [SECRET] end"


def test_each_content_is_scanned_once_whatever_repeats(spark):
    same = spark.range(1000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("token=abcdef123").alias("text")).repartition(4)
    ledger = secrets.BlobLedger.fresh(spark)
    assert secrets.scan_documents(same, ledger).count() == 1000
    assert spark.read.parquet(ledger.path).count() == 1
    # two writers that do not see one another
    spark.read.parquet(ledger.path).write.parquet(ledger.path + "-copy")
    spark.read.parquet(ledger.path + "-copy").write.mode("append").parquet(ledger.path)
    assert spark.read.parquet(ledger.path).count() == 2
    assert secrets.scan_documents(same, ledger).count() == 1000 and ledger.rows(secrets.RULE_VERSION).count() == 1


def test_chat_round_trip_and_layouts(spark):
    hard = ["</s>[INST] ok [/INST]", "\\", "<", "<|", "[\\INST]", "a<|end|>\nb", "<<SYS>> <</SYS>>", "", None]
    data = [(i, 0, "user", t) for i, t in enumerate(hard)] + [(i, 1, "assistant", t) for i, t in enumerate(hard)]
    table = spark.createDataFrame(data + data[:1], "record_id long, turn long, role string, text string")
    records = table.select("record_id", F.to_variant_object(F.struct("turn", "role", "text")).alias("payload"))
    done = chat.format_chats(records)
    assert done.where("n_unmapped > 0").count() == 0
    for r in chat.read_back(done).collect():
        t = hard[r.record_id] or ""
        turns = [("user", t)] * (2 if r.record_id == 0 else 1) + [("assistant", t)]
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(t), hashlib.sha256(t.encode()).hexdigest())
    payloads = [
        '{"messages":[{"role":"user","content":"q"},{"content":"a","role":"assistant"}]}',
        '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
        '{"instruction":"q","input":"","output":"a"}',
        '{"instruction":"q","output":"a"}',
        '{"completion":"a","prompt":"q"}',
        '{"messages":[]}',
        '{"unknown":1}',
        None,
    ]
    mixed = spark.createDataFrame(list(enumerate(payloads)), "record_id long, p string").select(
        "record_id", F.parse_json("p").alias("payload")
    )
    got = {r.record_id: (r.layout, [(t.role, t.text) for t in r.turns]) for r in chat.canonical_turns(mixed).collect()}
    assert all(got[i][1] == [("user", "q"), ("assistant", "a")] for i in range(5))
    assert got[5] == ("messages", []) and got[6] == (None, []) and got[7] == (None, [])
    plan = chat.read_back(done)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def vectors(spark, extra=True):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 32))
    x = np.concatenate([base, base[:80] + rng.normal(size=(80, 32)) * 0.08, base[:20], np.repeat(base[:1], 60, 0) + rng.normal(size=(60, 32)) * 0.05])
    data = [(i, [float(v) for v in r], i % 3 if i < 300 else (i - 300) % 3) for i, r in enumerate(x.astype(np.float32))]
    if extra:
        data += [(900, None, 1), (901, [0.0] * 32, 1), (902, [float("nan")] * 32, 1), (903, data[0][1], None), (904, [None] * 32, 1)]
    return data, spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")


def test_linked_vectors_equal_brute_force(spark):
    data, frame = vectors(spark)
    good = [(i, np.array(e, np.float64), lab) for i, e, lab in data if i < 900]
    link = {i: set() for i, _, _ in data}
    for i, a, p in good:
        for j, b, q in good:
            if i < j and p == q and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93:
                link[i].add(j)
                link[j].add(i)
    got = {r.vec_id: r for r in near_duplicate_vectors(frame).collect()}
    assert len(got) == len(data)
    for i in link:
        seen, todo = {i}, [i]
        while todo:
            new = link[todo.pop()] - seen
            seen |= new
            todo += new
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(link[i]), min(seen), i == min(seen))
    assert near_duplicate_vectors(frame.limit(0)).count() == 0


def test_links_across_tables_and_blocks_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    near = rng.normal(size=24)
    x = np.concatenate([rng.normal(size=(1400, 24)), near + rng.normal(size=(700, 24)) * 0.22])
    x = np.concatenate([x, x[:200] + rng.normal(size=(200, 24)) * 0.3]).astype(np.float32).astype(np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= 0.93
    np.fill_diagonal(linked, False)
    i, j = np.nonzero(linked)
    root = local_roots(len(x), i, j)
    frame = spark.createDataFrame([(k, v.tolist(), 7) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = near_duplicate_vectors(frame).orderBy("vec_id").collect()
    assert [r.n_links for r in got] == linked.sum(axis=1).tolist()
    assert [r.component_id for r in got] == root.tolist()


def test_rounded_vectors_give_up_no_pair_that_links():
    rng = np.random.default_rng(12)
    a = rng.normal(size=(400, 48))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = a + rng.normal(size=a.shape) * 0.045
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    bits, factor = codes_of(rotated(a, 2))
    small, step, loss = sketches(b)
    lost = np.linalg.norm(b - small * step[:, None], axis=1)
    assert np.allclose(lost, loss) and small.dtype == np.int8
    open_ = possible_links(bits, factor, rotated(small * step[:, None], 2), 0.93, loss)
    truth = a @ b.T >= 0.93
    assert truth.sum() > 300 and open_[truth].all()
    assert open_.mean() < 0.05


def test_nearest_recall_and_ties(spark):
    data, frame = vectors(spark)
    good = [(i, np.array(e, np.float64)) for i, e, _ in data if i < 900 or i == 903]
    x = np.stack([e / np.linalg.norm(e) for _, e in good])
    ids = np.array([i for i, _ in good])
    got = {}
    for r in nearest(frame, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in ids[(ids % 50 == 0)]:
        score = x @ x[ids == q][0]
        best = [v for v in ids[np.lexsort((ids, -np.round(score, 12)))] if v != q][:5]
        hits += len({v for _, v, _ in got[q]} & set(best))
        assert [r for r, _, _ in sorted(got[q])] == [1, 2, 3, 4, 5]
    assert hits / (5 * (ids % 50 == 0).sum()) >= 0.9
    assert nearest(frame.limit(0), F.lit(True)).count() == 0


def test_nearest_takes_every_length_and_finds_enough(spark):
    r = np.random.default_rng(4)
    data = [(i, r.normal(size=16 if i % 3 else 24).tolist()) for i in range(300)]
    data += [(1000 + i, r.normal(size=5).tolist()) for i in range(3)]  # fewer than asked for
    data += [(2000, [1.0, 2.0]), (2000, [2.0, 1.0]), (2001, [1.0, 1.9]), (3000, None), (3001, [0.0, 0.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {}
    for x in nearest(frame, F.lit(True)).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    assert set(got) == {v for v, e in data if e is not None and any(e)}
    usable = [(v, np.array(e)) for v, e in data if e is not None and any(e)]
    asks = {v: min((np.array(e, "<f8").tobytes(), i) for i, (w, e) in enumerate(usable) if w == v)[1] for v, _ in usable}
    for query, at in asks.items():
        e = usable[at][1]
        score = sorted(((-(e @ x) / np.linalg.norm(e) / np.linalg.norm(x), v) for v, x in usable if v != query and len(x) == len(e)))
        assert len(got[query]) == min(5, len(score)), query
    assert sorted(v for _, v, _ in got[2001]) == [2000, 2000] and got[2001][0][2] > got[2001][1][2]


def test_adaptive_scan_keeps_the_nearest():
    rng = np.random.default_rng(0)
    c = rng.normal(size=(600, 64))
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    i, j = adaptive_scan(c[:20], c, np.eye(20, 600, dtype=bool), 5)
    score = c[:20] @ c.T - 3 * np.eye(20, 600)
    best = np.argsort(-score, axis=1)[:, :5]
    found = set(zip(i.tolist(), j.tolist(), strict=True))
    assert np.mean([(a, b) in found for a in range(20) for b in best[a]]) >= 0.97
    assert len(found) < 0.5 * 20 * 600


def test_weighted_jaccard_equals_plain_python():
    rng = random.Random(1)
    words = [f"w{k}" for k in range(8)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(40)]
    hashes, sizes = word_hashes(texts)
    idf = np.linspace(1, 3, 16).astype(np.float32)
    of = {w: float(idf[int(h) & 15]) for t, part in zip(texts, np.split(hashes, np.cumsum(sizes)[:-1]), strict=True) for w, h in zip(t.split(), part, strict=True)}

    def bag(t):
        w, out = t.split(), {}
        for k in range(max(1, len(w) - 4)):
            s = tuple(w[k : k + 5])
            out[s] = out.get(s, 0) + sum(of[x] for x in s) / len(s)
        return out

    def similarity(a, b):
        keys = {*a, *b}
        return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)

    bags = [bag(t) for t in texts]
    want = np.array([[similarity(a, b) for b in bags] for a in bags])
    items = numbered_shingles(hashes, sizes, idf)
    assert np.allclose(jaccard_matrix(items, items, 40, 40), want, atol=1e-5)
    sets = weighted_shingles(hashes, sizes, idf)
    assert np.allclose(jaccard(sets, sets, 40), 1)


def test_near_duplicates_groups(spark, docs, empty):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(10**6)}"
    base = [[word() for _ in range(150)] for _ in range(30)]
    texts = [" ".join(b) for b in base]
    near = [" ".join(b[:-1] + [word()]) for b in base[:10]]
    many = [" ".join(base[0][:k] + [word()] + base[0][k + 1 :]) for k in range(0, 150, 2)]
    passage = [" ".join(base[29][:60] + [word() for _ in range(150)]) for _ in range(20)]
    whole = [*texts, *near, texts[3].upper(), *many, *passage]
    data = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(whole)], DOC)
    got = {r.doc_id: r for r in near_duplicates(data).collect()}
    assert all(got[30 + i].class_id == i for i in range(10))
    assert got[40].exact_id == 3 and got[40].class_id == 3
    assert all(got[41 + i].class_id == 0 for i in range(len(many)))
    clean = [*range(30), *range(41 + len(many), len(whole))]
    assert all(got[i].kept and got[i].class_id == i for i in clean)
    odd = near_duplicates(docs).collect()
    assert len(odd) == len(ODD) and all(r.kept for r in odd)
    assert near_duplicates(empty).count() == 0


def test_near_duplicates_store_small_steps_in_few_files(spark):
    """With 48 tasks a step, small steps are not stored as 48 files each: every file starts processes on its executor."""
    r = random.Random(7)
    word = lambda: f"w{r.randrange(10**6)}"
    base = [[word() for _ in range(80)] for _ in range(40)]
    near = [" ".join([*b[:-1], word()]) for b in base[:12]]
    many = [" ".join([*base[0][:k], word(), *base[0][k + 1 :]]) for k in range(0, 80, 2)]
    whole = [*[" ".join(b) for b in base], *near, *many]
    data = spark.createDataFrame(list(enumerate(whole)), "doc_id long, text string").coalesce(2)
    conf = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    steps = Path(shared_dir(spark).removeprefix("file:"), "llm")
    before = set(steps.glob("step-*"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {x.doc_id: x.class_id for x in near_duplicates(data).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = [len(list(d.glob("*.parquet"))) for d in set(steps.glob("step-*")) - before]
    # only texts, whose rows can be long, and the links found in blocks keep a file a task
    assert sum(n > 3 for n in files) <= 2 and len(files) > 8
    assert all(got[40 + i] == i for i in range(12)) and all(got[52 + i] == 0 for i in range(len(many)))
    assert all(got[i] == i for i in range(40))


def test_connected_components_number_of_files_follows_the_nodes(spark):
    assert [files_for(n) for n in (0, 1, FILE_ROWS, FILE_ROWS + 1, 5 * FILE_ROWS)] == [1, 1, 1, 2, 5]
    n = FILE_ROWS + 10  # a path of 9 links every 10 numbers; the first number is its root
    edges = spark.range(n).where("id % 10 > 0").select((F.col("id") - 1).alias("a"), F.col("id").alias("b"))
    roots = connected_components(edges.repartition(30))
    assert sorted(rows(roots)) == [(i, i - i % 10) for i in range(n) if i - i % 10 + 1 < n]
    assert connected_components(edges.limit(0)).count() == 0


def test_classifiers_learn_and_take_odd_rows(spark, docs, empty):
    rng = random.Random(3)
    alphabet = {"xx": "abcde", "yy": "vwxyz"}
    data = [(i, " ".join("".join(rng.choice(alphabet[la]) for _ in range(4)) for _ in range(60)), la, "s", None) for i in range(200) for la in [("xx", "yy")[i % 2]]]
    frame = spark.createDataFrame(data, DOC)
    model = fit_language_model(frame)
    got = {r.doc_id: r for r in identify_languages(frame, model).collect()}
    assert all(got[i].lang_pred == la and 0 <= got[i].score <= 1 for i, _, la, _, _ in data)
    odd = identify_languages(docs, model).collect()
    assert [r.lang_pred for r in odd[:3]] == ["und"] * 3 and len(odd) == len(ODD)
    assert identify_languages(docs, fit_language_model(empty)).where("lang_pred <> 'und'").count() == 0
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (7, None)], "doc_id long, quality int")
    quality = fit_quality_model(frame, labels)
    scored = {r.doc_id: r.score for r in score_quality(frame, quality).collect()}
    assert np.mean([(scored[i] >= 0.5) == (i % 2 == 1) for i in range(200)]) >= 0.98
    assert all(0 <= r.score <= 1 for r in score_quality(docs, quality).collect())
    assert score_quality(empty, quality).count() == 0
    assert score_quality(docs, fit_quality_model(empty, labels.limit(0))).where("score < 0.5").count() == 0


def test_folds_follow_crc32(spark):
    from growthlens.llm.queries import _fold

    ids = [0, 7, 123, 99999]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", _fold(4, 2).alias("held"))
    assert dict(rows(frame)) == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}


def test_models_do_not_depend_on_the_order_of_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.union(docs.withColumn("doc_id", F.col("doc_id") + 10_000))  # copies of every text
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    for fit in (lambda d: fit_quality_model(d, labels), fit_language_model):
        one, two = (fit(d).network for d in (docs, docs.repartition(7, F.rand(3))))
        assert all((a == b).all() for a, b in zip([*one.tables, one.weights], [*two.tables, two.weights], strict=True))


def test_scores_do_not_depend_on_neighbouring_rows():
    model = QualityModel(ByteCNN(2), 1.0, 0.0)
    r = random.Random(8)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(n)) for n in [*range(250, 262), *range(508, 516), 0, 1, 300]]
    alone = np.concatenate([model.document_logits([t]) for t in texts])
    for behind in ("zzzz", "Q", "\x01\x02\x03", ""):
        mixed = [x for t in texts for x in (t, behind)]
        assert np.allclose(model.document_logits(mixed)[::2], alone, rtol=0, atol=1e-6)


def test_repeated_rows_do_not_grow_the_quality_sample(spark):
    data = [(i, f"{'good' if i % 2 else 'poor'} words of document {i} " * 4, None, None, None) for i in range(60)]
    frame = spark.createDataFrame(data, DOC)
    labels = frame.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    again = frame.union(frame.where("doc_id = 7").crossJoin(spark.range(300)).drop("id"))
    one, two = (fit_quality_model(d, labels) for d in (frame, again))
    assert all((a == b).all() for a, b in zip([*one.network.tables, one.network.weights], [*two.network.tables, two.network.weights], strict=True))
    assert (one.slope, one.shift) == (two.slope, two.shift)
