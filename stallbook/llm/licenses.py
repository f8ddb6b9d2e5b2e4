"""License scans by ordered signature rules, as DataFrame functions only.

A text is folded to words: A-Z in lower case, every run of other ASCII signs one space. Rules are regexes over folded
words, grouped by the words they may begin with; each has a keyword. A document without any keyword is not scanned. At
every word that begins a rule, the rules whose keyword is in the next ``WIDEST`` words are tried there. Of a word's
matches the best stays (order of the kinds of rules, then length, then order of the rules), and a match that lies
inside another one of the same or an earlier kind is suppressed. All steps are linear in a text's words.

Base phrases are found besides, at every place, and are never suppressed.

Results for odd rows: a null or empty text has no words, no labels and score 0. Repeated rows each get their result,
null ids too; an empty table gives an empty one. Other columns are not looked at, so their names cannot clash.
"""

from __future__ import annotations

import json
import string
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDEST = 40     # words that a rule may look at from its first one on

# Phrases found at every place where their words stand one after the other, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Kinds of rules in their order, with how sure a match makes one that the text is under the license.
KINDS = {"notice": 1.0, "identifier": 1.0, "address": 0.9, "statement": 0.9, "name": 0.7, "short": 0.5}


@dataclass(frozen=True)
class Rule:
    kind: str
    label: str
    pattern: str        # over folded words, from one of ``first`` on
    keyword: str        # stands in every match
    first: tuple[str, ...]


# Families with versions: label, name, word that every name has, identifier and versions.
_LICENSE = "licen[sc]e"
FAMILIES = [
    ("gpl", rf"gnu general public {_LICENSE}", "gnu", "gpl", "1.0 2.0 3.0"),
    ("lgpl", rf"gnu (?:lesser|library) general public {_LICENSE}", "gnu", "lgpl", "2.0 2.1 3.0"),
    ("agpl", rf"gnu affero general public {_LICENSE}", "affero", "agpl", "1.0 3.0"),
    ("gfdl", rf"gnu free documentation {_LICENSE}", "documentation", "gfdl", "1.1 1.2 1.3"),
    ("apache", rf"apache (?:software )?{_LICENSE}", "apache", "apache", "1.0 1.1 2.0"),
    ("mpl", rf"mozilla public {_LICENSE}", "mozilla", "mpl", "1.0 1.1 2.0"),
    ("epl", rf"eclipse public {_LICENSE}", "eclipse", "epl", "1.0 2.0"),
    ("cddl", rf"common development and distribution {_LICENSE}", "development", "cddl", "1.0 1.1"),
    ("cpl", rf"common public {_LICENSE}", "common", "cpl", "1.0"),
    ("eupl", rf"european union public {_LICENSE}", "european", "eupl", "1.0 1.1 1.2"),
    ("osl", rf"open software {_LICENSE}", "open", "osl", "1.0 2.0 2.1 3.0"),
    ("afl", rf"academic free {_LICENSE}", "academic", "afl", "1.1 2.0 2.1 3.0"),
    ("artistic", rf"artistic {_LICENSE}", "artistic", "artistic", "1.0 2.0"),
    ("bsl", rf"boost software {_LICENSE}", "boost", "bsl", "1.0"),
    ("ofl", rf"sil open font {_LICENSE}", "sil", "ofl", "1.0 1.1"),
    ("cecill", rf"cecill (?:free software )?{_LICENSE}", "cecill", "cecill", "1.0 2.0 2.1"),
    ("zpl", rf"zope public {_LICENSE}", "zope", "zpl", "1.1 2.0 2.1"),
    ("psf", rf"python software foundation {_LICENSE}", "python", "psf", "2.0"),
    ("php", rf"php {_LICENSE}", "php", "php", "3.0"),
    ("odbl", rf"open database {_LICENSE}", "database", "odbl", "1.0"),
    ("lppl", rf"latex project public {_LICENSE}", "latex", "lppl", "1.0 1.2 1.3"),
    ("apsl", rf"apple public source {_LICENSE}", "apple", "apsl", "1.1 1.2 2.0"),
    ("spl", rf"sun public {_LICENSE}", "sun", "spl", "1.0"),
    ("qpl", rf"q public {_LICENSE}", "q", "qpl", "1.0"),
]
# The rest: label, name, first words of the name, keyword of the name, identifier.
OTHERS = [
    ("mit", rf"(?:mit|expat) {_LICENSE}", "mit expat", "licen", "mit"),
    ("x11", rf"x11 {_LICENSE}", "x11", "x11", "x11"),
    ("isc", rf"isc {_LICENSE}", "isc", "isc", "isc"),
    ("zlib", rf"zlib (?:libpng )?{_LICENSE}", "zlib", "zlib", "zlib"),
    ("0bsd", rf"zero clause bsd {_LICENSE}", "zero", "bsd", "0bsd"),
    ("bsd-2-clause", rf"(?:2|two) clause bsd {_LICENSE}", "2 two", "bsd", "bsd 2 clause"),
    ("bsd-2-clause", rf"(?:simplified bsd|freebsd) {_LICENSE}", "simplified freebsd", "bsd", "bsd 2 clause"),
    ("bsd-2-clause", rf"bsd (?:2|two) clause(?: {_LICENSE})?", "bsd", "clause", "bsd 2 clause"),
    ("bsd-3-clause", rf"(?:3|three) clause bsd {_LICENSE}", "3 three", "bsd", "bsd 3 clause"),
    ("bsd-3-clause", rf"(?:new|modified|revised) bsd {_LICENSE}", "new modified revised", "bsd", "bsd 3 clause"),
    ("bsd-3-clause", rf"bsd (?:3|three) clause(?: {_LICENSE})?", "bsd", "clause", "bsd 3 clause"),
    ("bsd-4-clause", rf"(?:4|four) clause bsd {_LICENSE}", "4 four", "bsd", "bsd 4 clause"),
    ("bsd-4-clause", rf"original bsd {_LICENSE}", "original", "bsd", "bsd 4 clause"),
    ("bsd", rf"bsd(?: style)? {_LICENSE}", "bsd", "bsd", "bsd"),
    ("unlicense", "unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("cc0", "cc0(?: (?:version )?1 0)?(?: universal)?", "cc0", "cc0", "cc0 1 0"),
    ("cc0", "creative commons zero(?: (?:version )?1 0)?(?: universal)?", "creative", "zero", "cc0 1 0"),
    ("ms-pl", rf"microsoft public {_LICENSE}", "microsoft", "public", "ms pl"),
    ("ms-rl", rf"microsoft reciprocal {_LICENSE}", "microsoft", "reciprocal", "ms rl"),
    ("postgresql", rf"postgresql {_LICENSE}", "postgresql", "postgresql", "postgresql"),
    ("ncsa", rf"ncsa (?:open source )?{_LICENSE}", "ncsa", "ncsa", "ncsa"),
    ("curl", rf"curl {_LICENSE}", "curl", "curl", "curl"),
    ("ftl", rf"freetype (?:project )?{_LICENSE}", "freetype", "freetype", "ftl"),
    ("ijg", rf"independent jpeg group {_LICENSE}", "independent", "jpeg", "ijg"),
    ("vim", rf"vim {_LICENSE}", "vim", "vim", "vim"),
    ("ruby", rf"ruby {_LICENSE}", "ruby", "ruby", "ruby"),
    ("sleepycat", rf"sleepycat {_LICENSE}", "sleepycat", "sleepycat", "sleepycat"),
    ("w3c", rf"w3c (?:software )?(?:notice and )?{_LICENSE}", "w3c", "w3c", "w3c"),
    ("json", rf"json {_LICENSE}", "json", "json", "json"),
    ("openssl", rf"openssl {_LICENSE}", "openssl", "openssl", "openssl"),
    ("beerware", rf"beer ?ware {_LICENSE}", "beer beerware", "beer", "beerware"),
    ("ecl", rf"educational community {_LICENSE}", "educational", "community", "ecl 2 0"),
    ("upl", rf"universal permissive {_LICENSE}", "universal", "permissive", "upl 1 0"),
]
# Creative Commons: the parts after "by" in short and in words.
COMMONS = {"by": "", "by-sa": " share ?alike", "by-nc": " non ?commercial", "by-nd": " no ?deriv(?:ative)?s",
           "by-nc-sa": " non ?commercial share ?alike", "by-nc-nd": " non ?commercial no ?deriv(?:ative)?s"}
_COMMONS_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
# Sentences of license texts and headers: label, words, keyword.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "obtaining"),
    ("isc", "permission to use copy modify (?:and )?(?:or )?distribute this software for any purpose with or without fee is "
            "hereby granted", "granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "binary"),
    ("bsd-3-clause", "neither the names? of (?:[^ ]+ ){1,12}nor the names of (?:its|their) contributors", "contributors"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising"),
    ("gpl", "this (?:program|file|software) is free software you can redistribute it and or modify it under the terms of the "
            "gnu general public license", "gnu"),
    ("lgpl", "this (?:library|program) is free software you can redistribute it and or modify it under the terms of the gnu "
             "(?:lesser|library) general public license", "gnu"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
             "general public license", "affero"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance",
     "apache"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v(?:ersion)? 2 0", "mozilla"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license",
     "eclipse"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held "
             "liable", "liable"),
    ("bsl-1.0", "distributed under the boost software license version 1 0", "boost"),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", "sil"),
    ("cc0", "to the extent possible under law (?:[^ ]+ ){1,12}waived all copyright", "waived"),
    ("public-domain", "released (?:in)?to the public domain", "domain"),
    ("public-domain", "dedicated to the public domain", "domain"),
    ("public-domain", "this (?:work|file|software|code|text) is in the public domain", "domain"),
    ("all-rights-reserved", "all rights reserved", "reserved"),
    ("proprietary", "proprietary and confidential", "confidential"),
]
_UNDER = ("licensed", "licenced", "released", "distributed", "published", "available", "provided", "covered", "offered")
_STATEMENT = rf"(?:{'|'.join(_UNDER)}) under (?:an? |the )?(?:terms (?:and conditions )?of )?(?:the )?"
_LATER = r"(?: or (?:any |at your option any )?(?:later|newer)(?: versions?)?| only)?"
_NOT_SHORT = ("apache", "artistic", "php")      # families without an abbreviation


def _number(version: str) -> str:
    major, minor = version.split(".")
    return f"{major}(?: 0)?" if minor == "0" else f"{major} {minor}"


def _after_name(version: str) -> str:
    """The ways to write a version after a name: 3, 3.0, v3 and version 3."""
    return rf" (?:version |ver )?(?:v |v)?{_number(version)}"


def rules() -> list[Rule]:
    """All rules, in order."""
    found = [Rule("notice", label, words, keyword, (words.partition(" ")[0],)) for label, words, keyword in NOTICES]

    def named(label: str, name: str, keyword: str, first: tuple[str, ...]) -> None:
        found.append(Rule("statement", label, _STATEMENT + name, keyword, _UNDER))
        found.append(Rule("name", label, name, keyword, first))

    def identified(label: str, short: str) -> None:
        found.append(Rule("identifier", label, f"spdx license identifier {short}", "identifier", ("spdx",)))
        found.append(Rule("address", label, f"(?:opensource|spdx|gnu) org licenses {short}", "org",
                          ("opensource", "spdx", "gnu")))

    for family, name, keyword, short, versions in FAMILIES:
        first = (name.partition(" ")[0],)
        for version in versions.split():
            label, number = f"{family}-{version}", version.replace(".", " ")
            named(label, name + _after_name(version) + _LATER, keyword, first)
            identified(label, f"{short} {number}(?: or later| only)?")
            if short not in _NOT_SHORT:
                glued = f"{short}v{version[0]}"
                found.append(Rule("short", label, f"(?:{glued}(?: 0)?|{short} (?:v|v |version ){_number(version)}|"
                                                  f"{short} {number})" + _LATER, short, (short, glued)))
        named(family, name + _LATER, keyword, first)
    for label, name, first, keyword, short in OTHERS:
        named(label, name, keyword, tuple(first.split()))
        identified(label, short)
    found.append(Rule("address", "apache-2.0", "apache org licenses license 2 0", "org", ("apache",)))
    for parts, words in COMMONS.items():
        short = parts.replace("-", " ")
        for version in [*_COMMONS_VERSIONS, None]:
            label = f"cc-{parts}-{version}" if version else f"cc-{parts}"
            after = _after_name(version) if version else ""
            named(label, rf"creative commons attribution{words}(?: {_LICENSE})?" + after, "commons", ("creative",))
            named(label, f"cc {short}{after}", "cc", ("cc",))
            if version:
                number = version.replace(".", " ")
                identified(label, f"cc {short} {number}")
                found.append(Rule("address", label, f"creativecommons org licenses {short} {number}", "org",
                                  ("creativecommons",)))
    return found


_RULES = rules()
FIRST = sorted({word for rule in _RULES for word in rule.first})
# A scanned document has one of these words: a first word that is no everyday word, or a word that the rules beginning
# with an everyday word need besides.
_EVERYDAY = {*_UNDER, "permission", "redistribution", "neither", "all", "this", "to", "dedicated", "proprietary",
             "zero", "2", "two", "3", "three", "4", "four", "new", "modified", "revised", "original", "simplified"}
_NEEDED = {"obtaining", "granted", "binary", "contributors", "advertising", "waived", "domain", "reserved",
           "confidential", "unencumbered", "liable", "bsd"}
GATE = sorted((set(FIRST) - _EVERYDAY) | _NEEDED)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once: a lambda's variable isn't copied into its uses."""
    return F.transform(F.array(value), body)[0]


def _words(folded: Column) -> Column:
    return F.when(folded == "", F.array().cast("array<string>")).otherwise(F.split(folded, " "))


def _rule_groups() -> Column:
    """The rules by first word, as one literal."""
    kinds = list(KINDS)
    groups = [{"first": word, "rules": [
        {"kind": kinds.index(rule.kind), "rule": k, "keyword": rule.keyword, "pattern": f"^(?:{rule.pattern})(?= |$)",
         "label": rule.label} for k, rule in enumerate(_RULES) if word in rule.first]} for word in FIRST]
    return F.from_json(F.lit(json.dumps(groups)), "array<struct<first:string,rules:array<struct<"
                                                  "kind:int,rule:int,keyword:string,pattern:string,label:string>>>>")


def _matched(words: Column) -> Column:
    """The best match at every word that begins one, by place."""
    def at(place: Column) -> Column:
        word = F.get(words, place)
        ahead = F.array_join(F.slice(words, place + 1, F.lit(WIDEST)), " ")
        group = F.filter(_rule_groups(), lambda g: g["first"] == word)[0]["rules"]

        def best(text: Column) -> Column:
            tried = F.transform(F.filter(group, lambda r: F.contains(text, r["keyword"])), lambda r: F.struct(
                r["kind"].alias("kind"), F.call_function("regexp_extract", text, r["pattern"], F.lit(0)).alias("matched"),
                r["rule"].alias("rule"), r["label"].alias("label")))
            hits = F.transform(F.filter(tried, lambda t: t["matched"] != ""), lambda t: F.struct(
                t["kind"].alias("kind"), (-F.size(F.split(t["matched"], " "))).alias("shorter"), t["rule"].alias("rule"),
                t["label"].alias("label")))
            return F.array_min(hits)

        return F.struct(place.alias("start"), _let(ahead, best).alias("best"))

    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(FIRST))
    found = F.filter(F.transform(places, at), lambda m: m["best"].isNotNull())
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), (m["start"] - m["best"]["shorter"]).alias("stop"),
                                                 m["best"]["kind"].alias("kind"), m["best"]["label"].alias("label")))


def _unsuppressed(matches: Column) -> Column:
    """Without those inside an earlier-starting one of the same or an earlier kind.

    One match begins at a word and none is longer than ``WIDEST`` words, so only so many before it can hold it.
    """
    def kept(match: Column, place: Column) -> Column:
        before = F.slice(matches, F.greatest(place - WIDEST, F.lit(0)) + 1, F.least(place, F.lit(WIDEST)))
        return ~F.exists(before, lambda m: (m["stop"] >= match["stop"]) & (m["kind"] <= match["kind"]))

    return F.filter(matches, kept)


_BASE = "array<struct<start:int,label:string>>"
_MATCHES = "array<struct<start:int,stop:int,kind:int,label:string>>"


def _places(words: Column, phrase: str, label: str) -> Column:
    """(start, label) wherever the phrase's words stand."""
    parts = phrase.split(" ")
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1),
                      lambda i: reduce(and_, [F.get(words, i + k) == part for k, part in enumerate(parts)]))
    found = F.transform(places, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))
    return F.when(F.array_contains(words, parts[0]), found).otherwise(F.array().cast(_BASE))




def licenses(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, base, matches) per row.

    ``base`` holds every place of a base phrase (start, label), ``matches`` what the rules found and nothing suppressed
    (start, stop, kind, label); places count words from 0, ``stop`` is exclusive, ``kind`` is a place in ``KINDS``.
    """
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    folded = F.trim(F.regexp_replace(F.coalesce(F.col(text_column), F.lit("")),
                                     r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "))

    def scanned(words: Column) -> Column:
        base = F.concat(*[_places(words, phrase, label) for phrase, label in BASE.items()])
        return F.struct(base.alias("base"), _let(_matched(words), _unsuppressed).alias("matches"))

    def looked_at(text: Column) -> Column:
        # ``lower`` also changes letters beyond ASCII, so it only serves to leave documents out.
        def gated(rough: Column) -> Column:
            exact = _words(F.translate(text, upper, lower))
            worth = F.arrays_overlap(rough, F.array(*[F.lit(word) for word in GATE]))
            return F.struct(F.size(rough).cast("long").alias("n_words"), F.when(worth, _let(exact, scanned)).alias("found"))

        return _let(_words(F.lower(text)), gated)

    each = documents.select(F.col(id_column).alias("id"), _let(folded, looked_at).alias("result"))
    return each.select("id", "result.n_words",
                       F.coalesce("result.found.base", F.array().cast(_BASE)).alias("base"),
                       F.coalesce("result.found.matches", F.array().cast(_MATCHES)).alias("matches"))


def summary(found: DataFrame) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row of ``licenses``."""
    starts = F.transform("base", lambda b: b["start"].cast("long"))
    base = F.transform("base", lambda b: b["label"])
    more = F.transform("matches", lambda m: m["label"])
    sure = F.array(*[F.lit(x) for x in KINDS.values()])
    score = F.array_max(F.concat(F.transform("matches", lambda m: F.get(sure, m["kind"])),
                                 F.transform("base", lambda b: F.lit(KINDS["name"]))))

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select("id", "n_words", F.size("base").cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        listed(base).alias("base_labels"), listed(F.concat(base, more)).alias("labels"),
                        F.coalesce(score, F.lit(0.0)).alias("score"))
