"""Operators that look at one row at a time, and packing and sharding: against the library itself or plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import corpus, words
from tokenizers import Tokenizer

from adperf.llm import language_id, license_scan, packing, sharding, token_counts, url_filter
from adperf.llm.queries import vocabulary


def test_token_counts(docs, rows, no_docs, monkeypatch):
    path = vocabulary("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    want = sorted((r[0], len((r[1] or "").encode()), n := len(t.encode(r[1] or "", add_special_tokens=False).ids), n > 50) for r in rows)
    assert sorted(map(tuple, token_counts.token_counts(docs, path, limit=50).collect())) == want
    assert token_counts.token_counts(no_docs, path).count() == 0


ODD_TEXTS = ["A<|endoftext|>b <|startoftext|> C", "<|EndOfText|> x", "a\u00a0b  c\td\r\ne\x0bf\x1cg", "İstanbul ΣΑΣ ﬁ é e\u0301", "don't I'LL we've", "12 3.5 ½ 四", "", " ", "\n\n x", "x \n y  ", "🙂🙂 a🙂", "word" * 3000]


@pytest.mark.parametrize("most", [7, 1 << 20])
def test_token_counts_at_safe_cuts(most, monkeypatch):
    path = vocabulary("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    monkeypatch.setattr(token_counts, "PIECE_CHARS", most)
    monkeypatch.setattr(token_counts.pieces, "__defaults__", (most,))
    assert token_counts.count_batch(ODD_TEXTS, path) == [len(t.encode(x, add_special_tokens=False).ids) for x in ODD_TEXTS]


def test_token_ids_are_the_librarys():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path = vocabulary("byte_bpe_50k.tiktoken")
    for x in [*ODD_TEXTS, *(r[1] for r in corpus(5) if r[1])]:
        assert packing.token_ids(x, path).tolist() == t.encode(x, add_special_tokens=False).ids, x[:50]


def test_token_ids_of_very_long_white_space_are_the_librarys():
    """Runs of 2,000,000, which the pattern's look-ahead cannot hold, and mixed ones about the length from which runs leave the pattern."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path = vocabulary("byte_bpe_50k.tiktoken")
    mixed = "".join(random.Random(6).choices(" \n\t\u00a0\u3000", k=packing.LONG_RUN + 1))
    texts = ["one" + " " * 2_000_000 + "two  three", "\n" * 2_000_000, *(a + mixed[:packing.LONG_RUN + i] + b for i in (-1, 0, 1) for a in ("", "a", "\x1c") for b in ("", "b", "\x1c", "<|endoftext|>c", "<|x"))]
    texts += [f"a{mixed}{last}b  c{mixed}<|endoftext|>{mixed}" for last in " \n\u00a0"]
    for x in texts:
        assert packing.token_ids(x, path).tolist() == t.encode(x, add_special_tokens=False).ids, (len(x), x[:20], x[-20:])


def test_packing(docs, rows, no_docs):
    path = vocabulary("byte_bpe_50k.tiktoken")
    got = packing.pack(docs, path, window=64).collect()
    ids = {r[0]: np.append(packing.token_ids(r[1], path), np.uint32(1)) for r in rows}
    copies = {r[0]: sum(x == r for x in rows) for r in rows}
    by_sequence: dict = {}
    ranges: dict = {}
    for g in got:
        whole = ids[g.doc_id]
        assert g.doc_tokens == len(whole) and g.ids_crc32 == zlib.crc32(whole[g.start:g.start + g.length].astype("<u4").tobytes())
        by_sequence.setdefault(g.sequence_id, []).append((g.offset, g.length))
        ranges.setdefault(g.doc_id, []).extend(range(g.start, g.start + g.length))
    for doc, whole in ids.items():
        assert sorted(ranges[doc]) == sorted([*range(len(whole))] * copies[doc])
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64 and at & (at - 1) == 0  # 64 itself, or a smaller power of two: nothing is padded
    assert packing.pack(no_docs, path).count() == 0


def test_sum_of_squares_level_is_the_best():
    rng = random.Random(3)
    p = packing.Packer(0, window=16)
    for i in range(300):
        size = rng.randint(1, 15)
        c = p.counts.copy()

        def cost(h, size=size, c=c):
            x = c.copy()
            if h:
                x[h] -= 1
            if h + size < 16:
                x[h + size] += 1
            return int((x[1:16] ** 2).sum())

        chosen = p.level(size)
        assert cost(chosen) == min(cost(h) for h in range(17 - size) if h == 0 or c[h])
        p.add(i, np.zeros(size, np.uint32))


def test_packer_closes_early_when_many_windows_are_open(monkeypatch):
    monkeypatch.setattr(packing, "MOST_OPEN", 3)
    p = packing.Packer(0, window=16)
    sizes = [random.Random(i).randint(1, 40) for i in range(200)]
    for i, n in enumerate(sizes):
        p.add(i, np.arange(n, dtype=np.uint32))
    p.close()
    assert sum(r[2] for r in p.rows) == sum(sizes)


def test_sharding(docs, rows, no_docs):
    got = sharding.shards(docs, n_shards=4, bundles=8, parts=4).collect()
    text = {r[0]: r[1] for r in rows}
    assert sorted(g.doc_id for g in got) == sorted(r[0] for r in rows)
    where: dict = {}
    for g in got:
        t = text[g.doc_id]
        assert g["size"] == len((t or "").encode()) + 1 and g.text_crc32 == zlib.crc32((t or "").encode()) and g.grown_shard is None and g.law == "bytes"
        assert where.setdefault(t, g.shard) == g.shard
    loads = [sum(g["size"] for g in got if g.shard == s) for s in range(4)]
    for s in range(4):
        assert sorted(g.slot for g in got if g.shard == s) == list(range(sum(g.shard == s for g in got)))
    largest = max(sum(len((r[1] or "").encode()) + 1 for r in rows if r[1] == t) for t in text.values())
    assert max(loads) <= max(largest, 1.05 * sum(loads) / 4)
    assert sharding.shards(no_docs).count() == 0


def test_best_fit_takes_the_tightest_bin():
    rng = random.Random(9)
    pack, free = sharding.BestFit(100), []
    for size in sorted((rng.randint(1, 120) for _ in range(400)), reverse=True):
        fits = [(left, b) for b, left in enumerate(free) if left >= size]
        b = pack.place(size)
        if fits:
            assert free[b] == min(fits)[0]
            free[b] -= size
        else:
            assert b == len(free)
            free.append(max(100, size) - size)


def test_least_capacity_holds_everything():
    sizes = sorted((random.Random(4).choices(range(1, 50), k=100)), reverse=True)
    capacity, where = sharding.least_capacity(sizes, 7)
    loads = [sum(s for s, b in zip(sizes, where, strict=True) if b == i) for i in range(7)]
    assert max(loads) <= capacity <= sum(sizes) / 7 * 1.1 and sum(loads) == sum(sizes)


def test_language_held_out_accuracy(spark, no_docs):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randint(3, 80), lang), lang if i % 5 else None, "s", 0) for i in range(400) for lang in [("en", "de")[i % 2]]]
    rows += [(1000, None, "en", "s", 0), (1001, "", None, "s", 0), (1002, "12 !!", "de", "s", 0)]
    got = {g.doc_id: g for g in language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    truth = {r[0]: ("en", "de")[r[0] % 2] for r in rows[:400]}
    held = [i for i in truth if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert held and sum(got[i].lang_pred == truth[i] for i in held) / len(held) > 0.97
    assert all(got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0 for i in (1000, 1001, 1002))
    assert all(0 <= g.score <= 1 for g in got.values())
    assert language_id.language_id(no_docs).count() == 0


def test_only_letters_count_as_letters(spark):
    rows = [(1, "and the others of them", "en"), (3, "und die anderen von ihnen", "de"), (4, "\u00bd \u00b2", None), (5, "\u2460 \u2461", None), (6, "12 \u0663\u0664 \u2167", None), (7, "_ \u0301", None), (8, "\u00aa", None), (9, "\u4e00", None)]
    got = {g.doc_id: g for g in language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all((got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True) for i in (4, 5, 6, 7))
    assert all(got[i].lang_pred in ("en", "de") for i in (1, 3, 8, 9))
    for c in map(chr, range(0x3000)):
        assert bool(language_id.letters(c)) == c.isalpha(), c


def test_samples_are_blocks_of_whole_texts(spark):
    """Each sample is a stretch of a text, and texts are cut at many places."""
    texts = ["".join(f" {chr(97 + i % 26)}{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(600)) for i in range(40)]
    docs = spark.createDataFrame([(4 * i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = language_id.fit(docs, slots=4096, snippet=100)["en"].decode().split("\n")
    whole = [language_id.letters(t) for t in texts]
    assert len(model) > 20 and all(any(m in t for t in whole) for m in model)
    assert len({next(t.index(m) for t in whole if m in t) for m in model}) > 10


def test_language_without_labels_is_undetermined(spark):
    df = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert language_id.language_id(df).first().lang_pred == "und"


def plain_scan(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in license_scan.BASE:
        p = phrase.split(" ")
        for k in range(len(w) - len(p) + 1):
            if w[k:k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def plain_labels(text):
    """All rules on the whole text, every pair of detections compared."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    joined = " " + " ".join(w) + " " if w else " "
    found = [(m.start(), m.end(), r.rank, r.label) for r in license_scan.signature_rules() if f" {r.keyword} " in joined for m in re.finditer(f" (?:{r.pattern})(?= )", joined)]
    return {x[3] for x in found if not any(y[0] <= x[0] and y[1] >= x[1] and (y[2] < x[2] or y[2] == x[2] and y[1] - y[0] > x[1] - x[0]) for y in found)}


LICENCES = ["Released under the MIT License.", "mit license mit LICENSE, mit-license", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-2.0-or-later", "Creative Commons Attribution-NonCommercial-ShareAlike 3.0", "cc by nc sa 4.0 cc by", "LGPL v2.1 and LGPLv3", "é MIT\u00a0license mit\u3000license", "mit", "All rights reserved"]


def test_license_scan(spark, rows, no_docs):
    long = (words(random.Random(1), 2000) + " ").join(LICENCES)
    texts = [*LICENCES, *(r[1] for r in rows), long, " ".join(LICENCES * 30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("joined", license_scan.F.lit(1))
    for g in license_scan.license_scan(df).collect():
        want = plain_scan(texts[g.doc_id])
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == want
        labels = plain_labels(texts[g.doc_id]) | set(filter(None, want[4].split(",")))
        assert g.labels == ",".join(sorted(labels)) and 0 <= g.score <= 1 and (g.score > 0) == bool(labels)
    assert len(license_scan.signature_rules()) > 200
    assert license_scan.license_scan(no_docs).count() == 0


URLS = ["https://A.Example.ORG/es/1", "http://example.org/en/12?x=1", "http://x.com/fr/1#a", "http://com/de/2", "http://example.net/", "http://example.org", "org/es/", None, "", "http://a.b.c/p?q=1&r=2", "http://notorg/x", "x://example.org/es/?a://b", "http://ünï.org/é", "http://example.org/es/"]


def plain_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_filter(spark):
    rng = random.Random(8)
    urls = URLS * 2 + [f"http://h{rng.randint(0, 9)}.example.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randint(1, 3000)}" for _ in range(300)]
    df = spark.createDataFrame([(i, u, "<html>", "x") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {g.page_id: g for g in url_filter.url_filter(df, trees=3, depth=3).collect()}
    assert sorted(got) == list(range(len(urls)))
    for i, u in enumerate(urls):
        host, path, rule, verdict = plain_rule(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if rule else got[i].verdict in ("allow", "block")
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.url_filter(none).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/"), (2, "http://a.org/")], "page_id long, url string")
    assert {g.verdict for g in url_filter.url_filter(one).collect()} == {"allow"}


