"""Cross-tokenizer alignment against the libraries and a brute-force version."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from growthlens.llm.alignment import VOCABULARY_A, VOCABULARY_B, TokenizerPair, align, aligned_groups, coalesced
from growthlens.llm.bpe import byte_chars
from tests.conftest import SF_SMALL, rows

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
LETTERS = [*"aab '\"sStT.,!0 1 \n\t\r\x0b\x1c\x85\xa0 éÀßçÿ×ªΣσİ漢🙂<|>▁ｈ", "<|endoftext|>", "</s>", "<s>", "<unk>", "'ll", "  ", "<0x0A>"]


def odd_texts(n, seed):
    r = random.Random(seed)
    return ["", "▁x", "  lead", *("".join(r.choice(LETTERS) for _ in range(r.randint(0, 25))) for _ in range(n))]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens(libraries, text):
    """(id, bytes) of both sides by the libraries; none where the bytes differ from the text's."""
    a, b = libraries
    byte_of = {c: i for i, c in enumerate(byte_chars())}
    if not text:
        return [], []
    left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    same = all(b"".join(x for _, x in side) == raw for side in (left, right))
    return (left, right) if same else ([], [])


def spans(side):
    out, at = [], 0
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def by_hand(libraries, text):
    """n_a, n_b, groups as text and links of one text."""
    a, b = map(spans, tokens(libraries, text))
    groups, low = [], 0
    for cut in sorted({e for _, _, e in a} & {e for _, _, e in b}):
        groups.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < cut) for side in (a, b)))
        low = cut
    links = [(i, j) for i, s, e in a for j, p, q in b if s < q and p < e]
    return len(a), len(b), groups, links


def brute(libraries, docs):
    found = [(k, *by_hand(libraries, t or "")) for k, t in docs]
    count = Counter(pair for *_, links in found for pair in set(links))
    top = {}
    for (i, _), n in count.items():
        top[i] = max(n, top.get(i, 0))
    return sorted(
        (
            (
                k, n_a, n_b, len(groups), len(links),
                sum(count[x] == top[x[0]] for x in links), sum(count[x] for x in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for k, n_a, n_b, groups, links in found
        ),
        key=str,
    )


def test_ids_and_links_of_odd_texts(libraries):
    pair, texts = TokenizerPair(VOCABULARY_A, VOCABULARY_B), odd_texts(800, 4)
    got = coalesced(pair, pair.encode(texts))
    for k, text in enumerate(texts):
        n_a, n_b, groups, links = by_hand(libraries, text)
        assert (got.n_a[k], got.n_b[k], got.n_groups[k], got.n_links[k]) == (n_a, n_b, len(groups), len(links))
        assert got.groups[k] == ";".join(groups)
        mine = got.link_doc == k
        assert sorted(zip(got.link_a[mine].tolist(), got.link_b[mine].tolist(), strict=True)) == sorted(links)


def test_ids_of_long_white_space(libraries):
    pair, r = TokenizerPair(VOCABULARY_A, VOCABULARY_B), random.Random(6)
    for _ in range(60):
        run = "".join(r.choice("\t\n\x0b\r \x85\xa0 　\x1c") for _ in range(700))
        run = r.choice([run, r.choice(" \n\t") * r.randint(480, 900)])
        text = r.choice(["", "x", "x ", "."]) + run + r.choice(["", "y", "\x1c", "1", " y"]) + r.choice(["", run, "z" + run + "q"])
        assert pair.ids_a(text) == libraries[0].encode(text, add_special_tokens=False).ids
    assert len(pair.encode(["\n" * 300_000 + "x"])[0][1]) > 0


def test_alignment_of_odd_rows_equals_brute_force(spark, libraries):
    texts = odd_texts(150, 8) + ["the same text here"] * 5 + [None, "word " * 3000]
    docs = [(k, t) for k, t in enumerate(texts)] + [(None, "no id"), (3, "a repeated id"), (3, "a repeated id")]
    table = spark.createDataFrame([(k, t, "x", "y") for k, t in docs], "doc_id long, text string, pairs string, slice string")
    short = [d for d in docs if d[1] is None or len(d[1]) < 1000]
    assert sorted(rows(align(table.where("text is null or length(text) < 1000")), *COLUMNS), key=str) == brute(libraries, short)
    whole = align(table)
    assert whole.count() == len(docs)
    assert rows(whole.where("doc_id = 159"), "n_a") == [(3001,)]
    groups = dict(rows(aligned_groups(table)))
    assert groups[0] == "" and groups[154] == ";".join(by_hand(libraries, "the same text here")[2])
    assert align(table.limit(0)).count() == 0


def test_counts_do_not_depend_on_slices(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 60")
    one, many = (rows(align(docs.repartition(n, F.col("doc_id"))), *COLUMNS) for n in (1, 7))
    assert sorted(one) == sorted(many)


def test_query_equals_brute_force(spark, libraries, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) < 1500")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = entry.queries()["op13_tokenizer_alignment"](spark, str(tmp_path))
    assert sorted(rows(got, *COLUMNS), key=str) == brute(libraries, rows(docs, "doc_id", "text"))
