"""Collocations against a plain version over word lists."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import collocations as C


def brute(rows, least=C.LEAST, top=C.TOP):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(words)
            for size in (1, 2, 3):
                for k in range(len(words) - size + 1):
                    f[lang, tuple(words[k:k + size])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in found.items():
        if any(x != words and lang == other and 100 * b >= C.COVERED * a and any(x[k:k + len(words)] == words for k in range(len(x)))
               for (other, x), b in found.items() if len(x) > len(words)):
            continue
        cuts = [(C.SCALE * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]])
                for k in range(1, len(words))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return [(lang, k + 1, p.decode(), -a, left, right, n[lang], -s)
            for lang in sorted(out) for k, (s, a, p, left, right) in enumerate(sorted(out[lang])[:top])]


def result(df, **kw):
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted((tuple(r) for r in C.collocations(df, **kw).select(cols).collect()), key=lambda r: (r[0], r[1]))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    words = ["the", "The", "of", "cat", "été", "Été", "x\x00y", "new", "york", "city", "and", "\x1c", "a-b"]
    out = []
    for k in range(300):
        lang = ("en", "de", None, "und")[k % 4]
        text = "".join(str(rng.choice(words, p=[.2, .05, .15, .1, .05, .05, .02, .1, .08, .1, .05, .03, .02])) + str(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n"]))
                       for _ in range(int(rng.integers(0, 40))))
        out.append((lang, text))
    return out + [("en", "new york city hall") for _ in range(30)] + [("en", None), ("fr", ""), ("xx", "only once here"), (None, "a b")]


@pytest.mark.parametrize("kw", [{}, {"top": 3}, {"numbered": 0}, {"trie": 7}])
def test_equals_brute_force(spark, rows, kw, monkeypatch):
    if kw.get("trie"):
        monkeypatch.setattr(C, "TALLY", 20)
        monkeypatch.setattr(C, "RUN", 100)
    df = (spark.createDataFrame(rows, "lang string, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
          .withColumn("doc_id", F.lit(None).cast("long")).repartition(4))
    assert result(df, **kw) == brute(rows, top=kw.get("top", C.TOP))


def test_long_text_and_ties(spark):
    rows = [("en", "alpha beta gamma " * 20_000), ("en", "w" * 50_000 + " z")]
    assert result(spark.createDataFrame(rows, "lang string, text string")) == brute(rows)


def test_empty_and_without_candidates(spark):
    assert result(spark.createDataFrame([], "lang string, text string")) == []
    assert result(spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")) == []


def test_hash_clash_is_resolved(spark, monkeypatch):
    plain = C.hash_column
    monkeypatch.setattr(C, "hash_column", lambda salt: plain(salt) if salt else F.lit(5).cast("long"))
    words = spark.createDataFrame([("en", "a", 1), ("en", "b", 1)], "lang string, word string, f long")
    out, salt = C.hashed(words)
    assert salt == "+" and {r.h for r in out.collect()} == {C.word_hasher("+", "en")(w) for w in (b"a", b"b")}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 12), st.integers(0, 12)), min_size=1, max_size=80), st.integers(0, 5))
def test_trie_holds_exactly_its_phrases(triples, spread):
    scale = 10 ** spread
    rows = {(a * scale, b * scale, c * scale) for a, b, c in triples} | {(a * scale, b * scale, 0) for a, b, _ in triples}
    phrases = np.array(sorted(rows))
    trie = C.Trie.build(phrases)
    assert sorted(trie.accept[trie.accept >= 0].tolist()) == list(range(len(phrases)))
    by = {tuple(p): k for k, p in enumerate(phrases.tolist())}
    text = np.append(np.random.default_rng(len(triples)).integers(0, 14, 400) * scale, [0, 0])
    want = Counter()
    for k in range(400):
        if (p := (text[k], text[k + 1], 0)) in by and text[k + 1]:
            want[by[p]] += 1
            if text[k + 2] and (q := (text[k], text[k + 1], text[k + 2])) in by:
                want[by[q]] += 1
    at = np.flatnonzero((text[:-2] != 0) & (text[1:-1] != 0))
    got = Counter(np.concatenate(list(trie.advance(text, at))).tolist())
    assert got == want


def test_pair_bitmap_stays_packed(spark):
    """The driver sends one bit per slot, not one byte; every pair is found, few others are."""
    pairs = [(k % 97 + 1, k * k % 1009 + 1) for k in range(3000)]
    found = spark.createDataFrame(pairs, "w1 long, w2 long")
    bitmap = C.pair_bitmap(found, 16)
    assert bitmap.nbytes == (1 << 16) // 8
    w = np.array(pairs + [(a + 2000, b) for a, b in pairs])
    held = C.in_bitmap(bitmap, C.pair_mix(w[:, 0], w[:, 1]))
    assert held[:len(pairs)].all() and held[len(pairs):].mean() < 0.2
    assert not C.in_bitmap(C.pair_bitmap(found.limit(0), 10), C.pair_mix(w[:, 0], w[:, 1])).any()
