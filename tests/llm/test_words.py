"""Spelling variants, periodic runs and the tokenization automaton against plain Python and the library."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from conftest import SCHEMA
from tokenizers import Tokenizer

from adperf.llm import bpe_automaton, periodic_runs, spelling
from adperf.llm.queries import vocabulary

WORD_BPE = "word_bpe_49k.json"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# Operator 11 ----------------------------------------------------------------------
def counted(rows, planted, min_chars=6, min_count=5):
    found = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if planted and h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            found[w] += 1
    return {w: n for w, n in found.items() if len(w) >= min_chars and n >= min_count}


def one_apart(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts, ratio=5):
    near = {w: [x for x in counts if one_apart(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root)
    return out


def as_found(df):
    got = [(r.word, (r.n, r.n_near, r.form, r.form_n, r.root)) for r in df.collect()]
    assert len(got) == len({w for w, _ in got})
    return dict(got)


def letters(rng, n, alphabet):
    return "".join(rng.choices(alphabet, k=n))


def dense_rows(seed=3):
    """Few letters, so that words have very many near words, chains of forms, repeated letters, both cases and letters beyond ASCII."""
    rng = random.Random(seed)
    pool = [letters(rng, rng.randint(5, 9), "ab") for _ in range(150)] + [letters(rng, rng.randint(6, 8), "aÀàß÷") for _ in range(40)] + ["a" * k for k in (6, 7, 8, 9, 200, 201)]
    rows = [(None, "Abcdefg " * 7, None, None, None), (7, None, None, None, None), (8, "", None, None, None), (9, "12 !? 漢字", None, None, None)]
    for i in range(60):
        text = " ".join(rng.choice(["", "x", "-"]).join((w.upper() if w.isascii() and rng.random() < 0.2 else w, " ")) for w in rng.choices(pool, weights=[1 + 40 * (k % 17 == 0) for k in range(len(pool))], k=300))
        rows.append((10 + i, text, "en", "s", 1))
    return [*rows, rows[10], rows[10]]


@pytest.mark.parametrize("most", [0, 3, spelling.BUCKET_PAIRS])
def test_spelling_variants(spark, most):
    rows = dense_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: spelling.F.lit("extra") for c in ("word", "n", "h", "run", "bucket", "base")})
    for planted in (True, False):
        want = plain_variants(counted(rows, planted))
        assert len(want) > 100 and max(x[1] for x in want.values()) > 5
        assert as_found(spelling.spelling_variants(df, planted, most=most)) == want


def test_one_hot_chunk_is_split(spark):
    """Words that share their first half, a third of them all, and few of which are near: candidates stay far below all pairs."""
    rng = random.Random(5)
    hot = {"commonpart" + letters(rng, 10, "abcdefgh") for _ in range(1500)}
    near = {w[:-1] + "z" for w in list(hot)[:50]}
    counts = {w: rng.randint(5, 100) for w in hot | near | {letters(rng, 20, "abcdefgh") for _ in range(1000)}}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {(r.word, r.other) for r in spelling.near_pairs(df, most=64).collect()}
    gone: dict = {}
    for w in counts:
        for i in range(len(w)):
            gone.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
    assert got == {(a, b) for group in gone.values() for a in group for b in group if a < b}
    level = spelling._level(spelling._halved(df.selectExpr("word", "n", "length(word) as base", "false as longer", "0 as a", "length(word) as b")), 64)
    assert level.where("hot").count() >= 1500 and level.where("not hot").count() < 3000


def test_chains_of_forms_end_at_the_root(spark):
    chain = ["abcdefghij"[:k] for k in range(3, 11)]
    df = spark.createDataFrame([(w, 6 ** k) for k, w in enumerate(chain)], "word string, n long")
    got = {r.word: r for r in spelling.with_roots(spelling.variants(df)).collect()}
    assert {r.root for r in got.values()} == {chain[-1]}
    assert [got[w].form for w in chain] == [*chain[1:], None]


def test_spelling_of_nothing(spark, no_docs):
    assert spelling.spelling_variants(no_docs, True).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(1, None, "", "", 0)], SCHEMA)).count() == 0


def test_spelling_of_a_very_long_text(spark):
    rng = random.Random(1)
    text = " ".join(letters(rng, 6, "ab") for _ in range(200_000)) + " " + "q" * 100_000
    rows = [(1, text, "", "", 0)]
    assert as_found(spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA))) == plain_variants(counted(rows, False))


# Operator 12 ----------------------------------------------------------------------
def plain_runs(w, min_words=24, min_exponent=3):
    """Every period, every stretch; a period with a smaller one is left out."""
    n, out = len(w), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(min_words, min_exponent * q):
                x = w[i:i + size]
                if not any(all(x[k] == x[k + d] for k in range(size - d)) for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    k, w = rng.choice([1, 2, 3, 30]), []
    while len(w) < rng.randint(1, 120):
        u = [bytes([97 + rng.randrange(k)]) for _ in range(rng.randint(1, 9))]
        w += u * rng.choice([1, 1, 2, 3, 4, 7])
    return w


@pytest.mark.parametrize(("min_words", "min_exponent"), [(24, 3), (3, 3), (6, 3), (12, 4)])
def test_runs_of_words(min_words, min_exponent):
    rng = random.Random(min_words)
    some = 0
    for _ in range(600):
        w = random_words(rng)
        want = plain_runs(w, min_words, min_exponent)
        some += bool(want)
        assert periodic_runs.stretch_runs(w, min_words, min_exponent) == want
        assert periodic_runs.runs(w, min_words, min_exponent) == want  # the parts that are left out hold no run
    assert some > 60


def test_automaton_links_are_longest_suffixes_seen_elsewhere():
    rng = random.Random(2)
    for _ in range(100):
        w = [rng.randrange(3) for _ in range(rng.randint(1, 30))]
        link, longest, prefixes = periodic_runs.suffix_automaton(w)
        assert [longest[p] for p in prefixes] == list(range(1, len(w) + 1))
        factors = {tuple(w[i:j]) for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        assert sum(longest[s] - longest[link[s]] for s in range(1, len(link))) == len(factors)


def test_access_tells_the_last_place_of_every_suffix():
    """Pieces of the path, from below: each suffix's last end before this one, compared with a search."""
    rng = random.Random(6)
    for _ in range(60):
        w = [rng.randrange(2) for _ in range(rng.randint(1, 40))]
        link, longest, prefixes = periodic_runs.suffix_automaton(w)
        tree = periodic_runs.PathColours([0, 0, *(x + 1 for x in link[1:])])
        for end, state in enumerate(prefixes, 1):
            pieces = [(longest[node - 1], before) for node, before in tree.access(state + 1, end)]
            for size in range(1, end + 1):
                last = max((e for e in range(size, end) if w[e - size:e] == w[end - size:end]), default=None)
                told = [before for longer, before in pieces if longer >= size]
                assert (told[-1] if told else None) == last


def plain_loops(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]


def test_periodic_runs(spark, rows, no_docs):
    rng = random.Random(9)
    more = [(5000 + i, b" \n".join(random_words(rng)).decode() + rng.choice(["", " ", " x"]), "en", "s", 0) for i in range(300)]
    more += [(None, "go " * 50, None, None, None), (None, None, None, None, None), (1, "a b c " * 8 + "a", "", "", 0), (2, "x y " * 30, "", "", 0), (3, "é " * 23, "", "", 0)]
    every = [*rows, *more]
    df = spark.createDataFrame(every, SCHEMA).withColumns({c: periodic_runs.F.lit("extra") for c in ("words", "runs", "n", "a", "p", "g", "found", "start", "best")})
    got = Counter(map(tuple, periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.looped(df))).collect()))
    want: Counter = Counter()
    for doc_id, text, *_ in every:
        w = plain_loops(doc_id, (text or "").encode().split())
        found = plain_runs(w) if len(w) < 700 else periodic_runs.runs(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        want[(doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())] += 1
    assert got == want and any(x[1] > 1 for x in want)
    assert periodic_runs.periodic_runs(no_docs).count() == 0


def test_runs_of_a_very_long_text():
    rng = random.Random(3)
    plain = [str(rng.randrange(10 ** 9)).encode() for _ in range(300_000)]
    loop = [str(i % 7000).encode() for i in range(100_000)]
    assert periodic_runs.runs(plain + loop + plain[:5000] + [b"a"] * 200_000) == [(300_000, 100_000, 7000), (405_000, 200_000, 1)]


def test_only_all_runs_can_be_asked_for():
    with pytest.raises(ValueError):
        periodic_runs.find(periodic_runs.F.col, min_exponent=2)


# Operator 13 ----------------------------------------------------------------------
ODD = ["A<|endoftext|>b <|startoftext|> C<|endoftext|><|endoftext|>", "<|EndOfText|> x<|x <<|endoftext|", "a b  c\td\r\ne\x0bf\x1cg\x85h", "İstanbul ΣΑΣ ﬁ é é ́x", "don't I'LL we've'S", "12 3.5 ½ 四", "", " ",
       "\n\n x", "x \n y  ", "🙂🙂 a🙂", "word" * 3000, "a" * 5000, "ab" * 501, "!" * 999, "é" * 300, "\x00\x7f\x01"]


def random_texts(seed, n):
    rng = random.Random(seed)
    return [letters(rng, rng.randint(1, 40), rng.choice(["aaabbeetthinso'!́é漢🙂 0", "aeothin", "aab", "</w> the", "ingÃİ"])) for _ in range(n)]


def test_encode_decode(spark, rows, no_docs):
    path = vocabulary(WORD_BPE)
    library = Tokenizer.from_file(path)
    every = [(r[0], r[1]) for r in rows] + [(10_000 + i, t) for i, t in enumerate(ODD + random_texts(1, 1500))] + [(None, "no id"), (None, None)]
    df = spark.createDataFrame(every, "doc_id long, text string").withColumns({c: bpe_automaton.F.lit("extra") for c in ("ids", "decoded", "n_tokens")})
    found = bpe_automaton.encode_decode(df, path)
    want = []
    for doc_id, text in every:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in found.collect()) == Counter((a, tuple(b), c) for a, b, c in want)
    digest = [(i, len(b), hashlib.sha256(" ".join(map(str, b)).encode()).hexdigest(), hashlib.sha256(c.encode()).hexdigest()) for i, b, c in want]
    assert Counter(map(tuple, bpe_automaton.digests(found).collect())) == Counter(digest)
    assert bpe_automaton.encode_decode(no_docs, path).count() == 0


def test_forgotten_chunks_change_nothing(monkeypatch):
    path = vocabulary(WORD_BPE)
    library = Tokenizer.from_file(path)
    monkeypatch.setattr(bpe_automaton, "REMEMBERED", 5)
    c = bpe_automaton.Codec(path)
    for text in ODD + random_texts(2, 50):
        ids, offsets = c.encode([text, text])
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want * 2 and offsets.tolist() == [0, len(want), 2 * len(want)]


def test_very_long_words():
    path = vocabulary(WORD_BPE)
    library = Tokenizer.from_file(path)
    for text in ("the" * 100_000, letters(random.Random(4), 200_000, "etaoin")):
        assert bpe_automaton.codec(path).encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def merged(word, merges):
    """Each merge in order, from the left."""
    symbols = list(word)
    for a, b in merges:
        out: list[str] = []
        for s in symbols:
            if out and out[-1] == a and s == b and out[-1] is not None:
                out[-1] = a + b
                out.append(None)  # a merged pair takes no part again in this merge
            else:
                out.append(s)
        symbols = [s for s in out if s is not None]
    return symbols


def accepted(word, labels, automaton, vocab):
    """All sequences of labels that spell the word and that the automaton accepts."""
    def walk(at, state):
        if at == len(word):
            yield []
        for x in labels:
            if word.startswith(x, at) and automaton.follows(state, vocab[x]):
                yield from ([x, *rest] for rest in walk(at + len(x), automaton.target[vocab[x]]))
    return list(walk(0, 0))


def test_the_automaton_accepts_exactly_the_tokenizations():
    """Random merge lists (with pairs of one symbol, and merges that can never happen): one path a text, and it is the merging's."""
    rng = random.Random(8)
    for _ in range(150):
        labels, merges = list("abc"), []
        for _ in range(rng.randint(0, 12)):
            a, b = rng.choice(labels), rng.choice(labels)
            if a + b not in labels:
                labels.append(a + b)
                merges.append((a, b))
        vocab = {x: i for i, x in enumerate(labels)}
        automaton = bpe_automaton.Automaton(vocab, merges)
        for _ in range(25):
            word = letters(rng, rng.randint(1, 9), "abc")
            want = merged(word, merges)
            assert accepted(word, [x for x in labels if automaton_has(automaton, vocab[x])], automaton, vocab) == [want]
            assert [labels[t] for t in automaton.encode(word)] == want


def automaton_has(automaton, token):
    """Whether a token has arcs at all: base symbols, and merges whose halves could stand side by side."""
    return not automaton.made[token] or token in leaves(automaton.tree)


def leaves(node):
    out = set()
    for k, v in node.items():
        if isinstance(v, dict):
            out |= leaves(v)
        else:
            out.add(v)
    return out


def test_merges_out_of_order_are_refused():
    vocab = {x: i for i, x in enumerate(["a", "b", "ab", "aba"])}
    with pytest.raises(ValueError):
        bpe_automaton.Automaton(vocab, [("ab", "a"), ("a", "b")])
