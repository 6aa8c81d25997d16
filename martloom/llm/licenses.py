"""License scan: ordered signature rules over normalised words, all in built-in functions.

A text becomes its lower-case words, each with a space on either side (" mit  license "), so a rule
is a plain regex over whole words and neighbours never share a space. Rules are gated twice: a few
stems per text, then each rule's own keyword. Detections carry character and word spans. A detection
is suppressed when one of a stronger tier, or an earlier one of the same tier, covers its span.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import ascii_lower

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Rule notation: words; "a|b" alternatives, "x?" an optional word. L stands for license/licence.
# (label, name, short name as in SPDX ids, versions). The name must hold a stem of STEMS.
FAMILIES = [
    ("gpl", "gnu? general public L", "gpl", ["1.0", "2.0", "3.0"]),
    ("lgpl", "gnu? lesser|library general public L", "lgpl", ["2.0", "2.1", "3.0"]),
    ("agpl", "gnu? affero general public L", "agpl", ["1.0", "3.0"]),
    ("gfdl", "gnu? free documentation L", "gfdl", ["1.1", "1.2", "1.3"]),
    ("apache", "apache software? L", "apache", ["1.0", "1.1", "2.0"]),
    ("mpl", "mozilla public L", "mpl", ["1.0", "1.1", "2.0"]),
    ("epl", "eclipse public L", "epl", ["1.0", "2.0"]),
    ("cpl", "common public L", "cpl", ["1.0"]),
    ("cddl", "common development and distribution L", "cddl", ["1.0", "1.1"]),
    ("eupl", "european union public L", "eupl", ["1.0", "1.1", "1.2"]),
    ("osl", "open software L", "osl", ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", "academic free L", "afl", ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("artistic", "artistic L", "artistic", ["1.0", "2.0"]),
    ("ofl", "sil? open font L", "ofl", ["1.0", "1.1"]),
    ("bsl", "boost software L", "bsl", ["1.0"]),
    ("busl", "business source L", "busl", ["1.1"]),
    ("sspl", "server side public L", "sspl", ["1.0"]),
    ("elastic", "elastic L", "elastic", ["2.0"]),
    ("apsl", "apple public source L", "apsl", ["1.0", "1.1", "1.2", "2.0"]),
    ("lppl", "latex project public L", "lppl", ["1.0", "1.1", "1.2", "1.3a", "1.3c"]),
    ("odbl", "open data commons? open? database|attribution L", "odbl", ["1.0"]),
    ("php", "php L", "php", ["3.0", "3.01"]),
    ("python", "python software? foundation? L", "psf", ["2.0"]),
    ("zpl", "zope public L", "zpl", ["1.1", "2.0", "2.1"]),
    ("ecl", "educational community L", "ecl", ["1.0", "2.0"]),
    ("efl", "eiffel forum L", "efl", ["1.0", "2.0"]),
    ("qpl", "q public L", "qpl", ["1.0"]),
    ("ipl", "ibm public L", "ipl", ["1.0"]),
    ("rpl", "reciprocal public L", "rpl", ["1.1", "1.5"]),
    ("cecill", "cecill free? software? L", "cecill", ["1.0", "1.1", "2.0", "2.1"]),
    ("npl", "netscape public L", "npl", ["1.0", "1.1"]),
    ("spl", "sun public L", "spl", ["1.0"]),
    ("upl", "universal permissive L", "upl", ["1.0"]),
    ("mulan", "mulan permissive software? L", "mulanpsl", ["1.0", "2.0"]),
    ("w3c", "w3c software? notice? and? L", "w3c", []),
    ("mit", "mit|x11 L", "mit", []),
    ("isc", "isc L", "isc", []),
    ("zlib", "zlib libpng? L", "zlib", []),
    ("ncsa", "ncsa open? source? L", "ncsa", []),
    ("postgresql", "postgresql L", "postgresql", []),
    ("openssl", "openssl L", "openssl", []),
    ("sleepycat", "sleepycat L", "sleepycat", []),
    ("vim", "vim L", "vim", []),
    ("ruby", "ruby L", "ruby", []),
    ("unlicense", "the unlicense", "unlicense", []),
    ("ms-pl", "microsoft public L", "ms pl", []),
    ("ms-rl", "microsoft reciprocal L", "ms rl", []),
    ("bsd-2-clause", "bsd 2|two|simplified clause? L", "bsd 2 clause", []),
    ("bsd-3-clause", "bsd 3|three|new|revised clause? L", "bsd 3 clause", []),
    ("bsd-4-clause", "bsd 4|four|original clause? L", "bsd 4 clause", []),
    ("bsd", "bsd L", "0bsd", []),
    ("beerware", "beer ware? L", "beerware", []),
    ("wtfpl", "do what the fuck you want to public L", "wtfpl", []),
    ("json", "json L", "json", []),
    ("curl", "curl L", "curl", []),
    ("ijg", "independent jpeg group L", "ijg", []),
]
# Creative Commons: elements of the short name and their long form.
CC_KINDS = {
    "by": "attribution",
    "by sa": "attribution share alike|sharealike",
    "by nc": "attribution non? commercial|noncommercial",
    "by nd": "attribution no? derivatives|noderivatives",
    "by nc sa": "attribution non? commercial|noncommercial share? alike|sharealike",
    "by nc nd": "attribution non? commercial|noncommercial no? derivatives|noderivatives",
}
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
PHRASES = [
    ("cc0", "cc0"), ("cc0", "creative commons zero"), ("public-domain", "dedicated to the public domain"),
    ("public-domain", "released into the public domain"), ("public-domain", "placed in the public domain"),
    ("proprietary", "all rights reserved license|licence"), ("gpl", "gpl"), ("lgpl", "lgpl"), ("agpl", "agpl"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted"),
]
# Every match of every rule holds one of these, so a text without any is passed over.
STEMS = ["licen", "gpl ", " cc", " creative ", " domain ", " hereby  granted ", " redistribution  and  use "]
CONFIDENCE = [1.0, 0.95, 0.8, 0.6]  # by tier; a text with base places alone has BASE_CONFIDENCE
BASE_CONFIDENCE = 0.5


class Rule(NamedTuple):
    keyword: str
    regex: str
    label: str
    tier: int


def _tokens(notation: str) -> list[str]:
    return ["license|licence" if t == "L" else t for t in notation.replace(".", " ").split()]


def regex_of(notation: str) -> str:
    out = []
    for token in _tokens(notation):
        optional, words = token.endswith("?"), token.removesuffix("?")
        body = f" (?:{words}) " if "|" in words else f" {words} "
        out.append(f"(?:{body})?" if optional else body)
    return "".join(out)


def keyword_of(notation: str) -> str:
    """The longest fixed run of words, as a plain string that every match holds."""
    runs, run = [], ""
    for token in _tokens(notation):
        run = run + f" {token} " if not token.endswith("?") and "|" not in token else ""
        runs.append(run)
    return max(runs, key=len) or "licen"


@lru_cache(maxsize=1)
def rules() -> list[Rule]:
    """All rules, strongest first: SPDX tags, names with a version, "licensed under", plain names."""
    tiers: list[list[Rule]] = [[], [], [], []]

    def add(tier: int, label: str, notation: str) -> None:
        keyword = "spdx" if tier == 0 else keyword_of(notation)
        tiers[tier].append(Rule(keyword, regex_of(notation), label, tier))

    def version_forms(v: str) -> list[str]:
        """"3.0" as "3 0", "v3 0", "3" and "v3"."""
        major, _, minor = v.partition(".")
        return [f"{major}|v{major} {minor}"] + ([f"{major}|v{major}"] if minor == "0" else [])

    for label, name, short, versions in FAMILIES:
        add(0, label, f"spdx L identifier {short}")
        add(2, label, f"licensed|distributed|released|available under the? terms? of? the? {name}")
        add(3, label, name)
        for v in versions:
            for form in version_forms(v):
                add(0, f"{label}-{v}", f"spdx L identifier {short} {form} or|only? later?")
                add(1, f"{label}-{v}", f"{name} version|v? {form} or? any? later? version?")
    for short, long in CC_KINDS.items():
        label = "cc-" + short.replace(" ", "-")
        add(3, label, f"cc {short}")
        add(3, label, f"creative commons {long}")
        add(2, label, f"licensed|released|available under the? a? cc {short}")
        for v in CC_VERSIONS:
            for form in version_forms(v):
                add(0, f"{label}-{v}", f"spdx L identifier cc {short} {form}")
                add(1, f"{label}-{v}", f"cc {short} {form}")
                add(1, f"{label}-{v}", f"creative commons {long} {form}")
    for label, phrase in PHRASES:
        add(3, label, phrase)
    # Inside a tier a longer form goes first, so "2 0" wins over "2".
    return [r for tier in tiers for r in sorted(tier, key=lambda r: (-len(r.regex), r.regex))]


def normalised(text: Column) -> Column:
    """Lower-case words, each with a space on either side; empty for no words or a null text."""
    words = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, "  "))
    return F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _words_in(norm: Column) -> Column:
    spaces = F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit("")))
    return (spaces / 2).cast("bigint")


def _rule_literal(entries: list[Rule]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(r.keyword).alias("keyword"), F.lit(r.regex).alias("regex"), F.lit(r.label).alias("label"), F.lit(r.tier).alias("tier"), F.lit(i).alias("rule"))
            for i, r in enumerate(entries)
        ]
    )


_SPAN = "struct<start:int,end:int,tier:int,rule:int,label:string>"


def _spans(norm: Column, entries: list[Rule]) -> Column:
    """All matches of the gated rules as (start, end, tier, rule, label), in characters of ``norm``.

    The matches and the text between them, laid end to end, give every position.
    """
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in entries})])
    present = F.filter(keywords, lambda k: F.contains(norm, k))
    gated = F.flatten(F.transform(present, lambda k: F.filter(_rule_literal(entries), lambda r: r["keyword"] == k)))
    cut = F.transform(gated, lambda r: F.struct(r.alias("r"), F.regexp_extract_all(norm, r["regex"], F.lit(0)).alias("hits"), F.split(norm, r["regex"]).alias("gaps")))
    cut = F.filter(cut, lambda x: F.size(x["hits"]) > 0)

    def located(x: Column) -> Column:
        def put(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(F.get(x["gaps"], i))
            end = start + F.length(F.get(x["hits"], i))
            span = F.struct(start.alias("start"), end.alias("end"), x["r"]["tier"].alias("tier"), x["r"]["rule"].alias("rule"), x["r"]["label"].alias("label"))
            return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(x["hits"]) - 1), start, put, lambda acc: acc["out"])

    return F.flatten(F.transform(cut, located))


def _unsuppressed(spans: Column) -> Column:
    """Spans not covered by a stronger one. In the order (start, longest first, strongest first) every
    cover of a span stands before it, so four running maxima of ends, one per tier, decide."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("neg"), s["tier"].alias("tier"), s["rule"].alias("rule"), s["label"].alias("label"))))

    def put(acc: Column, s: Column) -> Column:
        end = -s["neg"]
        covered = F.lit(False)
        for tier in range(len(CONFIDENCE)):
            covered = covered | ((F.lit(tier) <= s["tier"]) & (acc[f"t{tier}"] >= end))
        kept = F.struct(s["start"].alias("start"), end.alias("end"), s["tier"].alias("tier"), s["rule"].alias("rule"), s["label"].alias("label"))
        tops = [F.when(s["tier"] == tier, F.greatest(acc[f"t{tier}"], end)).otherwise(acc[f"t{tier}"]).alias(f"t{tier}") for tier in range(len(CONFIDENCE))]
        return F.struct(*tops, F.when(covered, acc["out"]).otherwise(F.array_append(acc["out"], kept)).alias("out"))

    zero = F.struct(*[F.lit(-1).alias(f"t{tier}") for tier in range(len(CONFIDENCE))], F.array().cast(f"array<{_SPAN}>").alias("out"))
    return F.aggregate(ordered, zero, put, lambda acc: acc["out"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, ``base`` and ``detections``: arrays of (label, tier, rule, first word, end word).

    ``base`` holds every place of the base phrases, unsuppressed; ``detections`` the rules' places that
    no stronger one covers. A null or empty text has no words and empty arrays. Rows stand alone:
    repeated rows give repeated results; columns of these names are replaced, others stay.
    """
    base_rules = [Rule(keyword_of(p), regex_of(p), label, 0) for p, label in BASE_PHRASES.items()]
    stem_gate = F.lit(False)
    for stem in STEMS:
        stem_gate = stem_gate | F.contains(F.col("_norm"), F.lit(stem))
    none = F.array().cast(f"array<{_SPAN}>")

    def in_words(spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["label"].alias("label"), s["tier"].alias("tier"), s["rule"].alias("rule"),
                _words_in(F.substring(F.col("_norm"), F.lit(1), s["start"])).alias("first_word"),
                _words_in(F.substring(F.col("_norm"), F.lit(1), s["end"])).alias("end_word"),
            ),
        )

    found = docs.drop("n_words", "base", "detections").withColumn("_norm", normalised(F.col("text")))
    return found.select(
        *[c for c in found.columns if c != "_norm"],
        _words_in(F.col("_norm")).alias("n_words"),
        in_words(F.when(stem_gate, _spans(F.col("_norm"), base_rules)).otherwise(none)).alias("base"),
        in_words(F.when(stem_gate, _unsuppressed(_spans(F.col("_norm"), rules()))).otherwise(none)).alias("detections"),
    )


def license_report(docs: DataFrame) -> DataFrame:
    """Per document: base places, labels and a score (the strongest tier's confidence; 0 for none)."""
    labels = lambda c: F.array_sort(F.array_distinct(F.transform(c, lambda s: s["label"])))
    starts = F.transform("base", lambda s: s["first_word"])
    confidence = F.array(*[F.lit(c) for c in CONFIDENCE])
    best = F.array_min(F.transform("detections", lambda s: s["tier"]))
    score = F.when(best.isNotNull(), F.get(confidence, best)).when(F.size("base") > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0))
    return scan_licenses(docs.select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(labels(F.col("base")), ",").alias("base_labels"),
        F.array_join(labels(F.concat("base", "detections")), ",").alias("labels"),
        score.alias("score"),
        labels(F.col("detections")).alias("method_labels"),
        F.size("detections").cast("bigint").alias("n_detections"),
    )
