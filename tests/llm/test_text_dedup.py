"""Near copies, repeated passages and repeated sentences against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash

from tidemark.llm import simhash_dedup, substring_dedup, suffix_dedup
from tidemark.llm.common import components

SCHEMA = "doc_id long, text string, id long, `key` string, fp string, shard string"


def table(spark, rows):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, 7, "k", "f", "s") for i, t in rows], SCHEMA)


def prose(rng, n):
    return " ".join(rng.choice(["the", "river", "Stone", "lamp", "öl", "paper", "blue", "window", "日本"]) + str(rng.randint(0, 40))
                    for _ in range(n))


# ---- components ---------------------------------------------------------------------------------

def test_components_of_paths_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(31)}, **{k: 100 for k in range(100, 130)}, **{k: 200 for k in (200, 201, 202)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- SimHash -------------------------------------------------------------------------------------

def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, bits):
    n = len(fps)
    label = list(range(n))
    for _ in range(n):
        before = list(label)
        for a in range(n):
            for b in range(a):
                if (fps[a] ^ fps[b]).bit_count() <= bits:
                    label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def test_fingerprint_matches_the_definition():
    rng = random.Random(1)
    for text in [None, "", " \t\n", "one", "One two", "a b c", "É É é x\x0by\x1cz", prose(rng, 300)]:
        assert simhash_dedup.fingerprint(text) == slow_fingerprint(text)


def test_simhash_groups_equal_brute_force(spark):
    rng = random.Random(2)
    base = prose(rng, 200)
    rows = [(None, "null id"), (3, None), (4, ""), (4, ""), (9, "   "), (1, base), (0, base), (1, base)]
    rows += [(20 + k, base.replace("river", "rivers", 1 + k % 2)) for k in range(6)]
    rows += [(40 + k, prose(rng, 4 + k)) for k in range(25)]
    got = simhash_dedup.simhash_dedup(table(spark, rows)).collect()
    assert len(got) == len(rows)
    fps = [slow_fingerprint(t) for _, t in rows]
    label = brute_groups(fps, 2)
    low = {}
    for (i, _), k in zip(rows, label):
        low[k] = min(x for x in (low.get(k), i) if x is not None) if (i is not None or k in low and low[k] is not None) else None
    want = sorted((str(i), f"{f:016x}", str(low[k])) for (i, _), f, k in zip(rows, fps, label))
    assert sorted((str(r.id), r.fingerprint, str(r.component_id)) for r in got) == want
    assert simhash_dedup.simhash_dedup(table(spark, [])).count() == 0


def test_simhash_hot_groups_are_cut_into_tiles(spark):
    rng = np.random.default_rng(3)
    center = int(rng.integers(0, 1 << 62))
    near = {center ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)} | {int(x) for x in rng.integers(0, 1 << 63, 200)}
    classes = spark.createDataFrame([(f,) for f in near], "fp long")
    edges = simhash_dedup.links(classes, block=32)
    got = dict(tuple(r) for r in components(edges).collect())
    fps = np.array(sorted(near), np.uint64)
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2)
    root = simhash_dedup.forest(len(fps), i, j)
    want = {int(f): int(fps[r]) for f, r in zip(fps, root)}
    assert {f: got.get(f, f) for f in want} == want


def test_pivot_table_never_discards_a_link():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 64, 300, np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 300, np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300, np.uint64))
    assert (np.abs(simhash_dedup.pivot_table(a).astype(int) - simhash_dedup.pivot_table(b)) <= 2).all()
    i, j = simhash_dedup.tile_links(a, b, 2)
    assert set(range(300)) <= {x for x, y in zip(i.tolist(), j.tolist()) if x == y}


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_links_agree_in_two_families_of_pivots(max_bits):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 64, 4000, np.uint64)
    b = a.copy()
    for _ in range(max_bits):
        b ^= np.uint64(1) << rng.integers(0, 64, len(a), np.uint64)
    ka, kb = (simhash_dedup.family_keys(simhash_dedup.pivot_table(x, max_bits), max_bits) for x in (a, b))
    assert (sum((x == y).astype(int) for x, y in zip(ka, kb)) >= 2).all()
    # the coordinates of a family tell apart nearly all values of its share of the bits
    values = 2.0 ** (64 // (max_bits + 2))
    assert min(len(np.unique(x)) for x in ka) > 0.9 * values * -np.expm1(-len(a) / values)


def test_distance_table_is_stored_once_per_fingerprint(spark):
    fps = np.random.default_rng(6).integers(0, 1 << 63, 50)
    rows = simhash_dedup.distance_table(spark.createDataFrame([(int(f),) for f in fps], "fp long")).collect()
    want = {int(f): d.tobytes() for f, d in zip(fps, simhash_dedup.pivot_table(fps.view(np.uint64)))}
    assert {r.fp: bytes(r.d) for r in rows} == want and {len(d) for d in want.values()} == {1 + 4 * simhash_dedup.PIVOTS}


# ---- suffix arrays -------------------------------------------------------------------------------

def brute_removal(rows, length=suffix_dedup.LENGTH):
    last = suffix_dedup.LAST
    data = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    owner = {}
    for key, raw in data:
        for k in range(len(raw) - length + 1):
            g = raw[k:k + length]
            owner[g] = min(owner.get(g, last), key)
    out = []
    for (i, _), (key, raw) in zip(rows, data):
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - length + 1):
            if owner[raw[k:k + length]] < key:
                gone[k:k + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((str(i), len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removal(frame, **options):
    return sorted((str(r.id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
                  for r in suffix_dedup.suffix_dedup(frame, **options).collect())


@pytest.mark.parametrize("options", [{}, {"hot": 3, "shard_bytes": 4000}])
def test_suffix_dedup_equals_brute_force(spark, options, monkeypatch):
    rng = random.Random(5)
    shared = [prose(rng, 30) for _ in range(4)] + ["a" * 300, "ab" * 90, "\x00" * 120]
    rows = [(None, shared[0] + " tail"), (3, None), (5, ""), (5, shared[1]), (5, shared[1] + "x"), (6, shared[1][:49])]
    for k in range(60):
        rows.append((100 + k // 2, prose(rng, rng.randint(1, 40)) + rng.choice(shared) + prose(rng, 5) + rng.choice(shared)[7:]))
    rows.append((90, rows[-1][1] * 30))
    if options:
        monkeypatch.setattr(suffix_dedup, "BLOCK", 3000)
        monkeypatch.setattr(suffix_dedup, "MERGE_BYTES", 5000)
        monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 5000)
        monkeypatch.setattr(suffix_dedup, "CHUNK", 500)
    assert removal(table(spark, rows), **options) == brute_removal(rows)


def test_suffix_dedup_of_an_empty_table_and_kept_columns(spark):
    assert suffix_dedup.suffix_dedup(table(spark, [])).count() == 0
    row = suffix_dedup.suffix_dedup(table(spark, [(1, "short")]), keep=["key", "shard"]).first()
    assert (row.id, row.kept, row.keep_0, row.keep_1) == (1, b"short", "k", "s")


def test_suffix_array_and_common_prefixes():
    rng = random.Random(6)
    raw = [("".join(rng.choice("ab") for _ in range(rng.randint(50, 120))) + "c" * rng.choice([0, 60])).encode() for _ in range(40)]
    data = np.frombuffer(b"".join([*raw, suffix_dedup.SENTINEL]), np.uint8)
    sizes = np.array([len(r) for r in raw])
    starts, counts = np.cumsum(sizes) - sizes, sizes - 49
    wanted = np.zeros(len(data), bool)
    for a, n in zip(starts, counts):
        wanted[a:a + n] = True
    order = suffix_dedup.suffix_array(data, wanted)
    text = data.tobytes()
    assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
    grams = [text[k:k + 50] for k in order.tolist()]
    assert grams == sorted(grams)
    got = suffix_dedup.common_prefixes(data, order, wanted, starts, counts)
    for a, b in zip(order.tolist(), order[1:].tolist()):
        assert got[b] == next((k for k in range(50) if text[a + k] != text[b + k]), 50)


class Batches:
    """Takes the place of a DataFrame whose batches are handled here."""

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return run


def removal_in_process(rows, shards=3, merges=5, buckets=4, hot=suffix_dedup.HOT):
    """The steps of `suffix_dedup.suffix_dedup` without Spark."""
    last = suffix_dedup.LAST
    docs = [pa.table({"shard": pa.array([k] * len(own), pa.int32()), "id": pa.array([i for i, _ in own], pa.int64()),
                      "key": pa.array([last if i is None else i for i, _ in own], pa.int64()), "text": pa.array([t for _, t in own], pa.string())})
            for k, own in ((k, rows[k::shards]) for k in range(shards))]

    def grouped(tables, by, function):
        whole = pa.concat_tables(tables)
        return [function(whole.filter(pc.equal(whole[by], k))) for k in sorted(set(whole[by].to_pylist()))]

    base = [b for d in docs for b in d.select(["shard", "text"]).to_batches()]
    entries = pa.Table.from_batches(suffix_dedup.anchor_rows(Batches(), buckets)(base))
    answers = pa.concat_tables(grouped([entries], "bucket", lambda t: suffix_dedup._repeated(t, hot)))
    own = lambda t, k: t.filter(pc.equal(t["shard"], k))
    contexts = [suffix_dedup._contexts(d, own(answers, k), merges) for k, d in enumerate(docs)]
    both = pa.concat_tables([answers, *grouped(contexts, "merge", suffix_dedup._merged)], promote_options="default")
    done = pa.concat_tables([suffix_dedup._removed(d, own(both, k), [], merges) for k, d in enumerate(docs)])
    return sorted((str(r["id"]), r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in done.to_pylist())


def repeating_rows(rng):
    shared = [prose(rng, 30) for _ in range(4)] + ["a" * 300, "ab" * 90, "\x00" * 120]
    rows = [(None, shared[0] + " tail"), (3, None), (5, ""), (5, shared[1]), (5, shared[1] + "x"), (6, shared[1][:49]), (7, shared[2]), (8, shared[2])]
    return rows + [(100 + k // 2, prose(rng, rng.randint(1, 30)) + rng.choice(shared) + prose(rng, 5) + rng.choice(shared)[7:]) for k in range(40)]


@pytest.mark.parametrize("options", [{}, {"hot": 3}, {"shards": 1}, {"shards": 7, "merges": 1, "buckets": 1}])
def test_steps_of_suffix_dedup_equal_brute_force(options, monkeypatch):
    rows = repeating_rows(random.Random(11))
    want = brute_removal(rows)
    assert removal_in_process(rows, **options) == want
    monkeypatch.setattr(suffix_dedup, "BLOCK", 2000)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 500)
    assert removal_in_process(rows, **options) == want
    # contexts that clash in their codes are told apart by their bytes
    monkeypatch.setattr(suffix_dedup, "context_codes", lambda words, begin, count: (begin * 0).astype(np.uint64))
    assert removal_in_process(rows, **options) == want


def test_only_contexts_that_can_share_strings_are_sorted(monkeypatch):
    rng = random.Random(12)
    once, twice = ["".join(rng.choice("abcdefgh") for _ in range(4000)) for _ in range(2)]
    rows = [(k, once) for k in range(6)] + [(10, twice), (11, "x" + twice[:2000] + "y" + twice[2000:])]
    sorted_bytes, classes = [], suffix_dedup.block_classes

    def block_classes(data, sizes, owners):
        sorted_bytes.append(len(data))
        return classes(data, sizes, owners)
    monkeypatch.setattr(suffix_dedup, "block_classes", block_classes)
    assert removal_in_process(rows, shards=8) == brute_removal(rows)
    assert sum(sorted_bytes) < 2000         # what copies have in common is one context per anchor; before: all of it was sorted


def test_merge_shards_get_contexts_compressed():
    rng = np.random.default_rng(13)
    sizes, owners = rng.integers(50, 114, 500), rng.integers(0, suffix_dedup.LAST, 500)
    data = rng.integers(97, 105, int(sizes.sum())).astype(np.uint8).tobytes()
    packed = suffix_dedup._pack(sizes, owners // 1000, data)
    got = suffix_dedup._unpack(500, 9 * 500 + len(data), packed)
    assert (got[0] == sizes).all() and (got[1] == owners // 1000).all() and got[2] == data
    assert len(packed) < len(data)          # before: more bytes than the contexts have


# ---- sentence spans ------------------------------------------------------------------------------

def brute_sentences(rows):
    last = substring_dedup.LAST
    seen, parsed = {}, []
    for i, t in rows:
        pieces, length, hashes = substring_dedup.runs(t or "")
        h = iter(hashes)
        spans = [(k, m, next(h)) for k, m in enumerate(length) if m]
        parsed.append((last if i is None else i, pieces, spans))
        for k, m, x in spans:
            seen[x] = min(seen.get(x, last), parsed[-1][0])
    out = []
    for (i, t), (key, pieces, spans) in zip(rows, parsed):
        gone, own = set(), set()
        for k, m, x in spans:
            if seen[x] < key or x in own:
                gone |= set(range(k, k + m))
            own.add(x)
        out.append((str(i), len(pieces), len(gone), None if t is None else "".join(p for k, p in enumerate(pieces) if k not in gone)))
    return sorted(out, key=str)


def test_sentence_runs():
    text = "One two. Three four five!\n" + "word " * 30 + "end. Short. Tail without a stop"
    pieces, length, hashes = substring_dedup.runs(text)
    assert "".join(pieces) == text and len(pieces) == 5
    assert length == [3, 2, 2, 0, 0] and len(hashes) == 3
    assert substring_dedup.runs("") == ([], [], [])


def test_substring_dedup_equals_brute_force(spark):
    rng = random.Random(7)
    sentence = lambda: prose(rng, rng.randint(3, 14)) + rng.choice([".", "!", "?\n", ". "])
    passage = "".join(sentence() for _ in range(8))
    rows = [(None, passage), (2, None), (3, ""), (4, passage), (4, passage), (1, "Intro. " + passage), (8, passage + "x. " + passage),
            (9, passage * 40), (10, "Same. Same.")]
    rows += [(20 + k, "".join(sentence() for _ in range(6)) + (passage if k % 3 == 0 else "")) for k in range(12)]
    got = sorted(((str(r.id), r.n_sentences, r.n_removed, r.text) for r in substring_dedup.substring_dedup(table(spark, rows)).collect()), key=str)
    assert got == brute_sentences(rows)
    removed = {i: n for i, _, n, _ in got}
    assert removed["1"] == 0 and removed["20"] > 0 and removed["21"] == 0
    assert substring_dedup.substring_dedup(table(spark, [])).count() == 0


def brute_all_runs(rows, sentences, words):
    """Every run of every text as a tuple of its sentences; no code of the operator."""
    last, seen, parsed = 1 << 63, {}, []
    for i, t in rows:
        pieces = re.findall(r"[^.!?\n]*[.!?\n]+[ \t\r\n]*|[^.!?\n]+", t or "")
        bare = tuple(p.strip(" \t\r\n") for p in pieces)
        size = [len(s.split(" ")) if s else 0 for s in bare]
        spans = [(a, z) for a in range(len(bare)) for z in range(a + (sentences if words else min(sentences, len(bare))), len(bare) + 1) if sum(size[a:z]) >= words]
        parsed.append((last if i is None else i, pieces, bare, spans))
        for a, z in spans:
            seen[bare[a:z]] = min(seen.get(bare[a:z], last), parsed[-1][0])
    out = []
    for (i, t), (key, pieces, bare, spans) in zip(rows, parsed):
        gone, own = set(), set()
        for a, z in spans:
            if seen[bare[a:z]] < key or bare[a:z] in own:
                gone |= set(range(a, z))
            own.add(bare[a:z])
        out.append((str(i), len(pieces), len(gone), None if t is None else "".join(p for k, p in enumerate(pieces) if k not in gone)))
    return sorted(out, key=str)


def sentence_rows(rng):
    """Texts of long and short sentences with whole, cut and moved repeats."""
    sentence = lambda: prose(rng, rng.choice([1, 2, 3, 9, 14, 30])) + rng.choice([".", "!", "?\n", ". "])
    passages = ["".join(sentence() for _ in range(n)) for n in (2, 3, 5, 9)]
    rows = [(None, passages[3]), (None, passages[3]), (2, None), (3, ""), (4, passages[3]), (4, passages[3]), (5, "One."), (6, "One."),
            (7, "Same. Same."), (8, "Same. Same. Same."), (9, passages[2] * 4)]
    return rows + [(20 + k // 2, "".join(sentence() for _ in range(rng.randint(0, 3))) + rng.choice(passages)
                    + "".join(sentence() for _ in range(rng.randint(0, 2)))) for k in range(40)]


def removed_sentences(frame, **options):
    return sorted(((str(r.id), r.n_sentences, r.n_removed, r.text)
                   for r in substring_dedup.substring_dedup(frame, **options).collect()), key=str)


def test_all_runs_equal_brute_force(spark):
    tail = prose(random.Random(8), 30) + ". Two words. Last words."
    rows = [(1, tail), (2, tail)]
    assert [r[2] for r in removed_sentences(table(spark, rows), every=True)] == [0, 3]
    rows += [(None if i is None else i + 10, t) for i, t in sentence_rows(random.Random(9))]
    assert removed_sentences(table(spark, rows), every=True) == brute_all_runs(rows, 2, 24)


def test_runs_by_sentences_alone_equal_brute_force(spark):
    rows = [(1, "Few words. Here."), (2, "Few words. Here."), (3, "Alone"), (4, "Alone."), (5, "Alone.\n"), (6, "Not. Alone.")]
    assert [r[2] for r in removed_sentences(table(spark, rows), words=0, every=True)] == [0, 2, 0, 0, 1, 0]
    rows += [(None if i is None else i + 10, t) for i, t in sentence_rows(random.Random(10))]
    for sentences in (2, 3):
        got = removed_sentences(table(spark, rows), sentences=sentences, words=0, every=True)
        assert got == brute_all_runs(rows, sentences, 0)


def test_repeat_lists_are_bounded_by_the_text(spark):
    text = " ".join(f"Word number {k} of the text." for k in range(30))
    rows = [(1, text)] + [(None, text)] * 50
    base = spark.createDataFrame(rows, "key long, text string").fillna({"key": substring_dedup.LAST})
    lists = substring_dedup.repeat_lists(substring_dedup.span_rows(base, 2, 24)).collect()
    assert len(lists) == 2 and all(len(r.repeats) <= 30 for r in lists)
    assert [r[2] for r in removed_sentences(table(spark, rows))] == [0] + [30] * 50
