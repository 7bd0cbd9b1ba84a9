"""Operators that compare documents: against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import edit_distance_to_part, near_components, shingles, without_repeats
from conftest import corpus, words
from pyspark.sql import functions as F

import corpus_pipeline
from adperf.llm import decontaminate, fingerprints, near_dedup, order, packing, substring_dedup, suffix_array
from adperf.llm.components import components
from adperf.llm.queries import vocabulary
from adperf.llm.shingles import shingle_sets

E3B0 = hashlib.sha256(b"").hexdigest()


# Fingerprints

def plain_winnow(hashes, window):
    """(hash, position) of the rightmost least hash of each window, in order."""
    if not hashes:
        return []
    out = []
    for i in range(max(1, len(hashes) - window + 1)):
        part = hashes[i:i + window]
        best = max(j for j, h in enumerate(part) if h == min(part)) + i
        if (hashes[best], best) not in out:
            out.append((hashes[best], best))
    return out


def test_winnowing_keeps_rightmost_minima(spark):
    rng = random.Random(6)
    texts = ["", "a", "a b", "a a a a a a a a a a a a a a a a a a a a", "a b c d e", *(" ".join(rng.choices("abc", k=rng.randint(1, 60))) for _ in range(30)), "x" * 100, "漢字" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    every = fingerprints.winnow(df, "text", "keys", window=1)  # a window of one keeps each gram
    hashes = {r.doc_id: [x >> fingerprints.POSITION_BITS for x in r["keys"]] for r in every.collect()}
    assert len(hashes[3]) == 16 and len(set(hashes[3])) == 1
    for window in (2, 5, 8):
        for r in fingerprints.winnow(df, "text", "keys", window=window).collect():
            got = [(x >> fingerprints.POSITION_BITS, fingerprints.MASK - (x & fingerprints.MASK)) for x in r["keys"]]
            assert got == plain_winnow(hashes[r.doc_id], window), texts[r.doc_id]


def test_match_guarantee(spark):
    rng = random.Random(3)
    shared = words(rng, fingerprints.GRAM + fingerprints.WINDOW - 1)
    df = spark.createDataFrame([(i, f"{words(rng, 30)} {shared} {words(rng, 30)}") for i in range(10)], "doc_id long, text string")
    kept = [set(r.h) for r in fingerprints.winnow(df, "text", "keys").select(fingerprints.hashes(F.col("keys")).alias("h")).collect()]
    assert all(a & b for a in kept for b in kept)


def test_match_guarantee_without_spaces(spark):
    """A passage without any space, at places that differ in every remainder; a long run beside short ones; a text of one long run."""
    rng = random.Random(4)
    shared = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(400))
    other = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    texts = [other(50 + i) + shared + other(40) for i in range(17)] + [f"{words(rng, 20)} {shared}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = [set(r.h) for r in fingerprints.winnow(df, "text", "keys").select(fingerprints.hashes(F.col("keys")).alias("h")).collect()]
    assert all(len(a & b) > 50 for a in kept for b in kept)
    near = fingerprints.fingerprints(df).collect()
    assert all(g.near_next > 0.4 for g in near if g.doc_id < 16)
    tokens = spark.createDataFrame([("a" * 16 + " " + "b" * 17 + "\tc",)], "t string").select(F.regexp_extract_all("t", F.lit(fingerprints.TOKEN), F.lit(0))).first()[0]
    assert tokens == ["a" * 16, *"b" * 17, "c"]


def test_fingerprints(docs, rows, no_docs):
    text = {r[0]: r[1] or "" for r in rows}
    ids = sorted(text)
    got = fingerprints.fingerprints(docs).collect()
    assert sorted(g.doc_id for g in got) == sorted(r[0] for r in rows)
    by_text = {}
    for g in got:
        t, after = text[g.doc_id], text[ids[(ids.index(g.doc_id) + 1) % len(ids)]]
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        assert g.n_chars == len(t) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
        assert by_text.setdefault(t, g.fingerprint) == g.fingerprint
        if t == edited:
            assert g.near_edited == 1 and g.edited_fingerprint == g.fingerprint
        a, b = shingles(t), shingles(edited)
        if len(a) > 100:
            assert abs(g.near_edited - len(a & b) / len(a | b)) < 0.3
    assert fingerprints.fingerprints(no_docs).count() == 0


def test_one_document_is_its_own_next(spark):
    g = fingerprints.fingerprints(spark.createDataFrame([(7, "abcdefgh")], "doc_id long, text string")).first()
    assert g.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and g.near_next == 1


def test_null_id_has_an_empty_next(spark):
    got = fingerprints.fingerprints(spark.createDataFrame([(None, "abcdefgh"), (1, "x y"), (1, "a")], "doc_id long, text string")).collect()
    assert sorted((str(g.doc_id), g.edited_sha256) for g in got)[-1] == ("None", hashlib.sha256(b"abcdef").hexdigest())
    assert len(got) == 3


@pytest.mark.parametrize("ranges", [1, 2, 7, 512])
def test_cyclic_next(spark, ranges):
    ids = sorted({random.Random(i).randrange(-(1 << 62), 1 << 62) for i in range(50)} | {5, 6, 7})
    got = {r.id: r.next for r in order.cyclic_next(spark.createDataFrame([(i,) for i in ids], "id long"), "id", ranges).collect()}
    assert got == dict(zip(ids, [*ids[1:], ids[0]], strict=True))


# Near-duplicates

def test_near_duplicates(docs, rows, no_docs):
    want = near_components([(r[0], r[1]) for r in rows])
    got = near_dedup.near_duplicates(docs).collect()
    assert sorted(g.doc_id for g in got) == sorted(r[0] for r in rows)
    for g in got:
        assert (g.n_shingles, g.component_id, g.kept) == (*want[g.doc_id], g.doc_id == want[g.doc_id][1])
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_near_duplicates_in_chains_and_crowds(spark):
    """Chains of edits, whose ends are not alike, and many documents that share much but not enough, with blocks of 4."""
    rng = random.Random(12)
    rows, i = [], 0
    for _ in range(3):
        w = words(rng, 120).split(" ")
        for _ in range(12):
            rows.append((i, " ".join(w)))
            at = rng.randrange(0, 110)
            w = [*w[:at], *(f"new{rng.random()}" for _ in range(5)), *w[at + 5:]]
            i += 1
    common = words(rng, 130)
    for _ in range(40):
        rows.append((i, common + " " + " ".join(f"own{rng.random()}" for _ in range(rng.choice([18, 22, 60])))))
        i += 1
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = near_components(rows)
    assert {g.doc_id: (g.n_shingles, g.component_id) for g in near_dedup.near_duplicates(df, block=4).collect()} == want


def test_near_duplicates_null_id(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f"), (None, None)], "doc_id long, text string")
    got = sorted((str(g.doc_id), str(g.component_id), g.kept) for g in near_dedup.near_duplicates(df).collect())
    assert got == [("2", "2", True), ("4", "2", False), ("None", "None", True), ("None", "None", True)]


def test_shingle_sets_count_like_plain_sets():
    texts = [r[1] for r in corpus(3)] + ["A b\x0bC\x0cd\x1ce f", "a b c d e a b c d e a b c d e"]
    flat, at = shingle_sets(pa.array(texts, pa.string()))
    seen = {}
    for t, a, b in zip(texts, at, at[1:], strict=False):
        want = shingles(t)
        assert b - a == len(want)
        assert seen.setdefault(want, tuple(flat[a:b])) == tuple(flat[a:b])
    assert len(set(seen.values())) == len(seen)


def test_odd_sketches_estimate_likeness():
    rng = np.random.default_rng(1)
    for share in (0.95, 0.85, 0.75, 0.6):
        n = 2000
        common = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
        sets = [np.concatenate((common, rng.integers(0, 1 << 63, (n - len(common)) // 2, dtype=np.uint64))) for _ in range(2)]
        least = near_dedup.minimums(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])]), 200)
        a, b = near_dedup.odd_sketches(least)
        est = near_dedup.estimate(np.bitwise_count(a ^ b).sum(), 200)
        assert abs(est - share) < 0.12


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 80)]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "x long, y long")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {g.id: g.component for g in got} == {x: find(x) for x in linked} and len(got) == len(linked)


# Substrings

@pytest.mark.parametrize("alphabet", [b"ab", b"a", b"abcdefgh", bytes(range(256))])
def test_two_stage_order(alphabet):
    rng = random.Random(len(alphabet))
    for _ in range(5):
        data = bytes(rng.choices(alphabet, k=300)) + b"ab" * 20 + b"a" * 30
        x = np.frombuffer(data, np.uint8)
        for depth in (1, 5, 8, 20):
            wanted = np.array(sorted(rng.sample(range(len(data) - depth), 150)))
            spare = np.concatenate((x, np.zeros(depth + 16, np.uint8)))
            got = suffix_array.two_stage(spare, wanted, depth)
            parts = [data[p:p + depth] for p in got]
            assert sorted(got) == wanted.tolist() and parts == sorted(parts)
            lcp = suffix_array.common_prefixes(spare, got, depth)
            for k in range(1, len(parts)):
                n = next((i for i in range(depth) if parts[k][i] != parts[k - 1][i]), depth)
                assert lcp[k] == n
            seen = [data[p:p + depth] for p in wanted]
            assert suffix_array.repeated(x, wanted, depth).tolist() == [p for p, s in zip(wanted, seen, strict=True) if seen.count(s) > 1]


def test_whole_suffix_order_of_a_text():
    data = b"mississippi$banana$bananas"
    spare = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(60, np.uint8)))
    assert suffix_array.two_stage(spare, np.arange(len(data)), 40).tolist() == sorted(range(len(data)), key=lambda p: data[p:] + b"\0" * 40)


@pytest.mark.parametrize(("length", "gram", "most"), [(200, 40, 1 << 14), (30, 8, 1 << 14), (30, 8, 1)])
def test_substring_dedup(spark, docs, rows, length, gram, most):
    want = {r[0]: w for r, w in zip(rows, without_repeats([r[1] for r in rows], length), strict=True)}
    got = substring_dedup.substring_dedup(docs, length=length, gram=gram, most_segments=most, keep_text=True).collect()
    assert sorted(g.doc_id for g in got) == sorted(r[0] for r in rows)
    for g in got:
        w = want[g.doc_id]
        assert (g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) == w[:4]
        assert g.kept == w[4].decode("utf-8", "ignore")
    assert any(w[1] for w in want.values()) and any(w[2] > 1 for w in want.values())


def test_substring_dedup_odd_tables(spark, no_docs):
    assert substring_dedup.substring_dedup(no_docs).count() == 0
    x = "0123456789" * 30
    df = spark.createDataFrame([(None, x), (None, "q" * 250), (1, "short"), (1, "z" + x), (1, None)], "doc_id long, text string")
    got = sorted((str(g.doc_id), g.n_bytes, g.n_removed, g.n_spans) for g in substring_dedup.substring_dedup(df).collect())
    assert got == [("1", 0, 0, 0), ("1", 5, 0, 0), ("1", 301, 300, 1), ("None", 250, 250, 1), ("None", 300, 300, 1)]


def test_substring_dedup_of_rows_without_an_id(spark):
    rng = random.Random(7)
    passage = words(rng, 60)
    texts = [None, "", *(f"{words(rng, 40)} {passage if i % 3 else ''} {words(rng, 30)}" for i in range(120))] + [passage] * 3
    got = sorted(tuple(g)[1:5] for g in substring_dedup.substring_dedup(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")).collect())
    assert got == sorted(x[:4] for x in without_repeats(texts, substring_dedup.LENGTH))


def test_segments_cover_each_string_once():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 0, 700, 720, 3000, 5000])
    text, first, n, _ = substring_dedup.minimizers(data, offsets, 50, 10)
    got = sorted((t, f + k) for t, f, c in zip(text, first, n, strict=True) for k in range(c))
    assert got == [(t, p) for t in range(5) for p in range(offsets[t + 1] - offsets[t] - 49)]


# Benchmark

def test_myers_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        item, text = ("".join(rng.choices("abc", k=rng.randint(1, 90))) for _ in range(2))
        distance, end = decontaminate.myers(item, text)
        assert distance == edit_distance_to_part(item, text)
        assert distance == len(item) or edit_distance_to_part(item, text[:end]) == distance


def edited(rng, text, errors):
    x = list(text)
    for _ in range(errors):
        at, kind = rng.randrange(len(x)), rng.random()
        x[at:at + 1] = [] if kind < 0.3 else [x[at], "#"] if kind < 0.6 else ["#"]
    return "".join(x)


def test_lower_case_is_by_character(spark):
    """One letter whose lower case is longer changes nothing for the others, on either side; sigma has one lower case."""
    item = "\u043f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440 \u03c3\u03b1\u03c3 " * 4
    bench = spark.createDataFrame([(1, item), (2, "\u0130stanbul " + "words of an item in it " * 3)], "item_id long, text string")
    texts = [item.upper(), "\u0130 " + item.upper() + " end", "\u0130stanbul " + "WORDS OF AN ITEM IN IT " * 3, "\u0130 nothing of the sort"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((g.doc_id, g.item_id, g.distance) for g in decontaminate.contamination(df, bench).collect())
    assert got == [(0, 1, 0), (1, 1, 0), (2, 2, 0)]
    assert all(len(decontaminate.same_length_lower(t)) == len(t) for t in texts)


def test_contamination(spark, no_docs):
    rng = random.Random(10)
    items = [(i, words(rng, rng.randint(10, 60))) for i in range(12)] + [(50, None), (51, "  "), (52, "tiny item")]
    rows = [(0, None), (1, "")]
    for i in range(80):
        k, item = items[i % 12]
        rows.append((10 + i, f"{words(rng, 40)} {edited(rng, item, rng.choice([0, 1, len(item) // 16, len(item) // 16 + 1, len(item) // 8])).upper()} {words(rng, rng.randint(0, 300))}"))
    rows += [(200, words(rng, 4000)), rows[5], (201, "a Tiny iTem here")]
    want = set()
    for doc, text in rows:
        for k, item in items:
            if text and item and item.strip() and (d := edit_distance_to_part(item, text.lower() if len(text) < 5000 else text[:0])) <= len(item) // 16:
                want.add((doc, k, d))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hit", F.lit(1))
    got = decontaminate.contamination(df, bench).collect()
    assert {(g.doc_id, g.item_id, g.distance) for g in got} == want and len(got) == len(want) + sum(1 for x in want if x[0] == rows[5][0])
    lower = dict(rows)
    for g in got:
        item = dict(items)[g.item_id]
        part = lower[g.doc_id].lower()[g.start:g.end]
        assert edit_distance_to_part(item, part) == g.distance
    blocks = list(decontaminate.item_blocks(bench, chars=300))
    assert len(blocks) > 2 and sum(map(len, blocks)) == 13
    kept = {r.doc_id for r in decontaminate.drop_contaminated(df, bench).collect()}
    assert kept == {r[0] for r in rows} - {w[0] for w in want}
    assert decontaminate.contamination(no_docs, bench).count() == 0 and decontaminate.contamination(df, bench.limit(0)).count() == 0


# Pipeline

def test_pipeline(spark, tmp_path, rows):
    rng = random.Random(77)
    item = words(rng, 40)
    docs = [*rows, (5000, f"{words(rng, 50)} {item} {words(rng, 50)}", "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.collect()
        kept = corpus_pipeline.stored(stage(spark, kept, str(tmp_path)), name)
        assert kept.columns == corpus_pipeline.COLUMNS
        seen.append((before, kept.collect()))
    (all_docs, spoken), (_, single), (_, cut), (_, clean) = seen
    gone = {r.doc_id for r in all_docs} - {r.doc_id for r in spoken}
    assert gone >= {r.doc_id for r in all_docs if not (r.text and any(c.isalpha() for c in r.text))} and len(gone) < 10
    component = near_components([(r.doc_id, r.text) for r in spoken])
    assert {r.doc_id for r in single} == {i for i, (_, c) in component.items() if i == c}
    rest = without_repeats([r.text for r in single], 200)
    assert {r.doc_id: r.text for r in cut} == {r.doc_id: w[4].decode("utf-8", "ignore") for r, w in zip(single, rest, strict=True)}
    assert all(r.n_chars == len(r.text) for r in cut)
    assert {r.doc_id for r in cut} - {r.doc_id for r in clean} == {5000}
    path = vocabulary("byte_bpe_50k.tiktoken")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    lengths = {}
    for p in pieces:
        lengths[p.doc_id] = lengths.get(p.doc_id, 0) + p.length
    once = {r.doc_id: len(packing.token_ids(r.text, path)) + 1 for r in clean}
    copies = {i: sum(r.doc_id == i for r in clean) for i in once}
    assert lengths == {i: n * copies[i] for i, n in once.items()}


def test_empty_pipeline(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
