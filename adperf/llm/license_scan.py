"""Operator 6: licence scan, DataFrame functions only.

Words are looked up in a keyword list; only texts with a keyword are matched.
Ordered signature rules run over the words joined by single spaces, each only if
its keyword occurs; a detection inside one of a better rank is suppressed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import ascii_lower

#: Words after A-Z are lower-cased: runs of digits, a-z and characters beyond ASCII.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose consecutive words are counted, and their labels.
BASE = [("mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


@dataclass(frozen=True)
class Rule:
    """A signature: ``pattern`` is a regular expression over words joined by single spaces, tried only if ``keyword`` is one of them. A lower rank is better."""

    label: str
    rank: int
    keyword: str
    pattern: str


def _versions(*numbers: str) -> list[tuple[str, str]]:
    """(version, its words): 2.1 is the words 2 and 1."""
    return [(v, v.replace(".", " ")) for v in numbers]


def signature_rules() -> list[Rule]:
    """The rules in order: ranks 0 tag lines, 1 full names with a version, 2 names, 3 short forms and loose mentions."""
    out: list[Rule] = []
    gnu = [("gpl", "general public license", ("1.0", "2.0", "3.0")), ("lgpl", "(?:lesser|library) general public license", ("2.0", "2.1", "3.0")), ("agpl", "affero general public license", ("1.0", "3.0"))]
    for short, name, numbers in gnu:
        for v, words in _versions(*numbers):
            whole = words.removesuffix(" 0") if v.endswith(".0") else words
            number = f"{whole}(?: 0)?" if v.endswith(".0") else words
            for form, tail in (("only", " only"), ("or-later", " or later")):
                out.append(Rule(f"{short}-{v}-{form}", 0, short, rf"spdx license identifier {short} {number}{tail}"))
                out.append(Rule(f"{short}-{v}-{form}", 1, "gnu", rf"gnu {name} version {number}{' only' if form == 'only' else ' (?:of the license )?or (?:at your option )?any later version'}"))
            out.append(Rule(f"{short}-{v}", 0, short, rf"spdx license identifier {short} {number}"))
            out.append(Rule(f"{short}-{v}", 2, "public", rf"(?:gnu )?{name} (?:as published by the free software foundation )?(?:either )?(?:version|v) ?{number}"))
            out.append(Rule(f"{short}-{v}", 2, "gnu", rf"gnu org licenses (?:old licenses )?{short} {number}"))
            out.append(Rule(f"{short}-{v}", 3, short, rf"{short} (?:v|version )?{number}"))
            out.append(Rule(f"{short}-{v}", 3, f"{short}v{whole.split(' ')[0]}", rf"{short}v{number}"))
        out.append(Rule(short, 4, "public", rf"(?:gnu )?{name}"))
        out.append(Rule(short, 4, short, rf"(?:gnu )?{short} license"))
    for kind, words in (("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nc", "attribution non ?commercial"), ("by-nd", "attribution no ?deriv(?:ative)?s"), ("by-nc-sa", "attribution non ?commercial share ?alike"), ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s")):
        short = kind.replace("-", " ")
        for v, number in _versions("1.0", "2.0", "2.5", "3.0", "4.0"):
            out.append(Rule(f"cc-{kind}-{v}", 0, "spdx", rf"spdx license identifier cc {short} {number}"))
            out.append(Rule(f"cc-{kind}-{v}", 1, "creative", rf"creative commons {words} {number}"))
            out.append(Rule(f"cc-{kind}-{v}", 1, "creativecommons", rf"creativecommons org licenses {short} {number}"))
            out.append(Rule(f"cc-{kind}-{v}", 3, "cc", rf"cc {short} {number}"))
        out.append(Rule(f"cc-{kind}", 4, "creative", rf"creative commons {words}"))
        out.append(Rule(f"cc-{kind}", 4, "cc", rf"cc {short}"))
    out.append(Rule("cc0-1.0", 1, "cc0", r"cc0(?: 1 0)?(?: universal)?"))
    out.append(Rule("cc0-1.0", 1, "creativecommons", r"creativecommons org publicdomain zero 1 0"))
    # Other families: (label, SPDX words, name, keyword of the name).
    families = [
        ("mit", "mit", r"mit (?:style )?licen[sc]e", "mit"), ("mit-0", "mit 0", r"mit no attribution", "mit"), ("mit", "mit", r"permission is hereby granted free of charge to any person obtaining a copy", "permission"),
        ("apache-1.1", "apache 1 1", r"apache (?:software )?licen[sc]e (?:version )?1 1", "apache"), ("apache-2", "apache 2 0", r"apache (?:software )?licen[sc]e (?:version )?2(?: 0)?", "apache"), ("apache-2", "apache 2 0", r"apache org licenses licen[sc]e 2 0", "apache"),
        ("bsd-2-clause", "bsd 2 clause", r"(?:simplified|freebsd|2 clause) bsd licen[sc]e", "bsd"), ("bsd-2-clause", "bsd 2 clause", r"bsd 2 clause", "bsd"), ("bsd-3-clause", "bsd 3 clause", r"(?:new|modified|revised|3 clause) bsd licen[sc]e", "bsd"), ("bsd-3-clause", "bsd 3 clause", r"bsd 3 clause", "bsd"),
        ("bsd-4-clause", "bsd 4 clause", r"(?:original|old|4 clause) bsd licen[sc]e", "bsd"), ("0bsd", "0bsd", r"zero clause bsd", "bsd"), ("mpl-1.1", "mpl 1 1", r"mozilla public licen[sc]e (?:version |v )?1 1", "mozilla"), ("mpl-2.0", "mpl 2 0", r"mozilla public licen[sc]e (?:version |v )?2(?: 0)?", "mozilla"),
        ("epl-1.0", "epl 1 0", r"eclipse public licen[sc]e (?:version |v )?1(?: 0)?", "eclipse"), ("epl-2.0", "epl 2 0", r"eclipse public licen[sc]e (?:version |v )?2(?: 0)?", "eclipse"), ("cddl-1.0", "cddl 1 0", r"common development and distribution licen[sc]e", "development"), ("cpl-1.0", "cpl 1 0", r"common public licen[sc]e", "common"),
        ("isc", "isc", r"isc licen[sc]e", "isc"), ("zlib", "zlib", r"zlib licen[sc]e", "zlib"), ("bsl-1.0", "bsl 1 0", r"boost software licen[sc]e", "boost"), ("unlicense", "unlicense", r"unlicense org", "unlicense"), ("unlicense", "unlicense", r"released into the public domain", "public"), ("wtfpl", "wtfpl", r"do what the fuck you want to public licen[sc]e", "want"),
        ("artistic-1.0", "artistic 1 0", r"artistic licen[sc]e 1 0", "artistic"), ("artistic-2.0", "artistic 2 0", r"artistic licen[sc]e (?:version )?2(?: 0)?", "artistic"), ("python-2.0", "python 2 0", r"python software foundation licen[sc]e", "python"), ("postgresql", "postgresql", r"postgresql licen[sc]e", "postgresql"), ("openssl", "openssl", r"openssl licen[sc]e", "openssl"),
        ("ofl-1.1", "ofl 1 1", r"sil open font licen[sc]e", "font"), ("eupl-1.2", "eupl 1 2", r"european union public licen[sc]e", "european"), ("osl-3.0", "osl 3 0", r"open software licen[sc]e", "open"), ("ms-pl", "ms pl", r"microsoft public licen[sc]e", "microsoft"), ("ms-rl", "ms rl", r"microsoft reciprocal licen[sc]e", "microsoft"), ("ecl-2.0", "ecl 2 0", r"educational community licen[sc]e", "educational"),
        ("afl-3.0", "afl 3 0", r"academic free licen[sc]e", "academic"), ("odbl-1.0", "odbl 1 0", r"open database licen[sc]e", "database"), ("pddl-1.0", "pddl 1 0", r"public domain dedication and licen[sc]e", "dedication"), ("bsl-1.1", "busl 1 1", r"business source licen[sc]e", "business"), ("sspl-1.0", "sspl 1 0", r"server side public licen[sc]e", "server"), ("elastic-2.0", "elastic 2 0", r"elastic licen[sc]e", "elastic"),
        ("vim", "vim", r"vim licen[sc]e", "vim"), ("ruby", "ruby", r"ruby licen[sc]e", "ruby"), ("php-3.01", "php 3 01", r"php licen[sc]e", "php"), ("ncsa", "ncsa", r"university of illinois ncsa open source licen[sc]e", "ncsa"), ("upl-1.0", "upl 1 0", r"universal permissive licen[sc]e", "universal"), ("all-rights-reserved", "licenseref proprietary", r"all rights reserved", "rights"),
    ]
    for label, spdx, name, keyword in families:
        out.append(Rule(label, 0, "spdx", rf"spdx license identifier {spdx}"))
        out.append(Rule(label, 2, keyword, name))
        out.append(Rule(label, 3, "licensed", rf"licensed under (?:the |an? )?{spdx}"))
    return list(dict.fromkeys(out))


#: Texts are matched in parts of CORE characters with MARGIN characters on either side; no pattern matches a longer text than MARGIN.
CORE, MARGIN = 4096, 400


def _lower(text: Column) -> Column:
    """A-Z in lower case; other letters may be too, which stay characters of words.

    Only two other letters become ASCII ones in lower case; texts with them take the slower way.
    """
    odd = text.contains("\u212a") | text.contains("\u0130")
    return F.when(odd, ascii_lower(text)).otherwise(F.lower(text))


def any_of(words: list[str]) -> str:
    """A regular expression of some words as a tree of their letters, so that a mismatch shows at the first letter."""
    if "" in words:
        rest = any_of([w for w in words if w])
        return f"(?:{rest})?" if rest else ""
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[0], []).append(w[1:])
    parts = [head + any_of(tails) for head, tails in sorted(heads.items())]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})" if parts else ""


def joined_words(text: Column) -> Column:
    """The words joined by single spaces, with a space before and behind; a single space if there are none."""
    inner = F.trim(F.regexp_replace(_lower(F.coalesce(text, F.lit(""))), NO_WORD, " "))
    return F.when(inner == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def _spaces(c: Column) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))).cast("long")


def places(joined: Column, phrase: str) -> Column:
    """Struct (n, first, last) of the word numbers at which the words of a phrase stand consecutively; null if nowhere.

    The joined words are cut at the phrase, and the words of the pieces counted.
    """
    n = len(phrase.split(" "))
    pieces = F.split(joined, rf" {phrase}(?= )", -1)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))

    def step(s: Column, piece: Column) -> Column:
        here = s["at"] + _spaces(piece)
        return F.struct((here + F.lit(n)).alias("at"), (s["n"] + 1).alias("n"), F.coalesce(s["first"], here).alias("first"), here.alias("last"))

    found = F.aggregate(F.slice(pieces, 1, F.size(pieces) - 1), start, step, lambda s: F.struct(s["n"], s["first"], s["last"]))
    return F.when(joined.contains(f" {phrase} "), found)


def _spans(part: Column, rule: Column) -> Column:
    """Detections of a rule in a part of the text: (start, end, rank, label)."""
    pattern = F.concat(F.lit(" (?:"), rule["pattern"], F.lit(")(?= )"))
    between, hits = F.split(part, pattern, -1), F.regexp_extract_all(part, pattern, F.lit(0))
    pairs = F.zip_with(F.slice(between, 1, F.size(hits)), hits, lambda b, h: F.struct(F.length(b).alias("gap"), F.length(h).alias("long")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,rank:int,label:string>>").alias("found"))

    def step(s: Column, x: Column) -> Column:
        here = s["at"] + x["gap"]
        span = F.struct(here.alias("start"), (here + x["long"]).alias("end"), rule["rank"].alias("rank"), rule["label"].alias("label"))
        return F.struct((here + x["long"]).alias("at"), F.concat(s["found"], F.array(span)).alias("found"))

    return F.aggregate(pairs, start, step, lambda s: s["found"])


def _let(value: Column, use) -> Column:
    """use(value) with the value computed once: a lambda's argument is, an expression used twice is not."""
    return F.transform(F.array(value), use)[0]


def detections(joined: Column, rules: list[Rule]) -> Column:
    """Array of (rank, label) of the detections that none of a better rank, or longer one of the same rank, contains."""
    table = F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(r.rank).alias("rank"), F.lit(f" {r.keyword} ").alias("keyword"), F.lit(r.pattern).alias("pattern")) for r in rules])
    words = F.array(*[F.lit(f" {k} ") for k in sorted({r.keyword for r in rules})])

    def kept(found: Column, left: Column) -> Column:
        inside = lambda x, y: (y["start"] <= x["start"]) & (y["end"] >= x["end"]) & ((y["rank"] < x["rank"]) | ((y["rank"] == x["rank"]) & (y["end"] - y["start"] > x["end"] - x["start"])))
        own = F.filter(found, lambda x: (x["start"] >= left) & (x["start"] < left + F.lit(CORE)) & ~F.exists(found, lambda y: inside(x, y)))
        return F.transform(own, lambda x: F.struct(x["rank"].alias("rank"), x["label"].alias("label")))

    def part_at(offset: Column) -> Column:
        left = F.least(offset, F.lit(MARGIN))
        part = F.substring(joined, offset - left + 1, left + F.lit(CORE + MARGIN))
        spans = lambda p, present: F.flatten(F.transform(F.filter(table, lambda r: F.array_contains(present, r["keyword"])), lambda r: _spans(p, r)))
        return _let(part, lambda p: _let(F.filter(words, lambda k: F.contains(p, k)), lambda present: _let(spans(p, present), lambda found: kept(found, left))))

    offsets = F.sequence(F.lit(0), F.greatest(F.length(joined) - 1, F.lit(0)), F.lit(CORE))
    keywords = any_of(sorted({r.keyword for r in rules}))
    none = F.array().cast("array<struct<rank:int,label:string>>")
    return F.when(joined.rlike(rf" {keywords} "), F.array_distinct(F.flatten(F.transform(offsets, part_at)))).otherwise(none)


def license_scan(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    Null and empty texts have no words, null first and last word, empty labels
    and score 0. The score is 1 for a tag line and 0.2 less for each worse rank;
    a base phrase counts as rank 1. Repeated rows are judged alike, other
    columns are ignored. Row-local, with memory in proportion to a text.
    """
    rules = signature_rules() if rules is None else rules
    rows = docs.select(F.col(id_col).alias("doc_id"), joined_words(F.col(text_col)).alias("joined"))
    rows = rows.select("doc_id", (_spaces(F.col("joined")) - 1).alias("n_words"), *[places(F.col("joined"), phrase).alias(label) for phrase, label in BASE], detections(F.col("joined"), rules).alias("detections"))
    base = [(F.col(f"`{label}`"), label) for _, label in BASE]
    known = F.array_compact(F.array(*[F.when(c.isNotNull(), F.lit(label)) for c, label in base]))
    least, most = F.least(*[c["first"] for c, _ in base]), F.greatest(*[c["last"] for c, _ in base])
    best = F.array_max(F.transform("detections", lambda d: F.lit(1.0) - d["rank"] * F.lit(0.2)))
    return rows.select(
        "doc_id", "n_words", sum((F.coalesce(c["n"], F.lit(0).cast("long")) for c, _ in base), F.lit(0).cast("long")).alias("n_base"), least.alias("first_word"), most.alias("last_word"),
        F.array_join(F.array_sort(known), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(known, F.transform("detections", lambda d: d["label"]))), ",").alias("labels"),
        F.coalesce(F.greatest(best, F.when(F.size(known) > 0, 0.8)), F.lit(0.0)).alias("score"), "detections")
