"""Cross-tokenizer alignment against a plain version over token lists."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import common
from tidemark.llm import cross_alignment as X


def brute(rows):
    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    alphabet = X.byte_level_alphabet()
    docs = []
    for i, text in rows:
        raw = (" " + (text or "")).encode()
        a = a_tok.encode(" " + text, add_special_tokens=False) if text else None
        a = [(k, bytes(alphabet[c] for c in a_tok.id_to_token(k))) for k in a.ids] if text else []
        b = b_tok.encode(text) if text else []
        b = [(k, bytes([k - 3]) if b_tok.is_byte(k) else b_tok.id_to_piece(k).replace("▁", " ").encode()) for k in b]
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            a, b = [], []
        spans = []
        for side in (a, b):
            at, out = 0, []
            for k, x in side:
                out.append((at, at + len(x), k))
                at += len(x)
            spans.append(out)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups, low = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(x[2]) for x in s if low < x[1] <= c) for s in spans))
            low = c
        docs.append((i, a, b, links, groups))
    count = Counter(p for d in docs for p in set(d[3]))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(((i, len(a), len(b), len(g), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for i, a, b, links, g in docs), key=str)


COLUMNS = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [None, "", " ", "  two  spaces\n\n\tand tabs", "the cat sat on the mat", "the cat sat on the mat", "The Cat's été \U0001f600!",
         "<|endoftext|> <s> <unk> <0x41>", "under▁mark", "a\x00b", "ﬁne ½", "x" * 300, "你好 world 12345", "antidisestablishmentarianism"]


@pytest.fixture(scope="module")
def rows():
    return [(k if k % 5 else None, t) for k, t in enumerate(TEXTS)] + [(4, "the cat sat on the mat"), (4, "another row of this id")]


@pytest.mark.parametrize("part_keys", [X.PART_KEYS, 20])
def test_equals_brute_force(spark, rows, part_keys, monkeypatch):
    if part_keys == 20:
        monkeypatch.setattr(X, "BUCKET_TOKENS", 30)  # several buckets, several parts
    df = (spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("a", F.lit("x"))
          .withColumn("code", F.lit(2)).repartition(3))
    got = sorted((tuple(r) for r in X.align(df, part_keys=part_keys).select(COLUMNS).collect()), key=str)
    assert got == brute(rows)


def test_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 1000)
    rows = [(1, "one two three. " * 2000), (2, "one two"), (3, "")]
    got = {r.id: r for r in X.align(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {r[0]: r for r in brute([(2, "one two"), (3, "")])}
    assert got[1].n_links >= got[1].n_a > 6000 and got[1].n_groups > 0
    assert got[2].n_a == want[2][1] and got[2].groups_sha256 == want[2][7] and got[3].groups_sha256 == ""


def test_empty_table(spark):
    assert X.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_perfect_hash_is_minimal_and_verified():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 20000))
    parts = [(k, X.bucket_levels(keys[X.bucket_of(keys, 3) == k])) for k in range(3)]
    ph = X.PerfectHash(3, parts)
    ph.store(keys)
    assert ph.size == len(keys) and sorted(ph.find(keys).tolist()) == list(range(len(keys)))
    assert (ph.find(np.setdiff1d(np.arange(5000), keys)) == -1).all()
    assert (X.PerfectHash(3, []).find(keys[:5]) == -1).all()


def test_rank_encoder_gives_the_ids_of_the_library():
    import duckdb

    p = X.pair()
    assert p.by_ranks is not None
    texts = [t for t, in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    texts += [t for t in TEXTS if t] + ["a\x1cb\x85c\xa0 d", "x" * 5000, "\n" * 3000 + "y", "ſ ǅ İ ß ²³ ¼ º"]
    for t in texts:
        assert list(p._ids_a(" " + t)) == p.a.encode(" " + t, add_special_tokens=False).ids
