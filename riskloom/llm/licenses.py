"""License detection by ordered signature rules, on DataFrame functions alone (operator 2).

Texts are lower-cased and cut into words. Rules are regular expressions over words joined by one space.
Each rule is gated by a keyword: where a text has the keyword, and only there, the rule is tried on the
words around, with the keyword marked by ``#`` (no word holds that sign), so that each match belongs to
one place. Every family of licenses has three rules: an identifier tag, a grant ("licensed under ...")
and a bare mention, of falling priority. A detection is dropped if another of the same or a higher
priority contains it; of equal intervals and priorities the smaller label stays. The base phrases are
counted apart and their labels always stay.

All of it happens inside the row: there is no shuffle, and a text of any length is read whole. Null and
empty texts have no words and score 0. Repeated rows are judged alike. Only the id and text columns are
read.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_VERSION = r"(?: (?:version|v))?(?: \d+(?: \d+){0,2}| v\d+(?: \d+)?)?(?: (?:only|or(?: any)? later(?: version)?))?"
_LICENSE = r"(?: public)?(?: software)?(?: license| licence)"

#: Families: label, identifier in words, and the name as words before the keyword, the keyword, and after.
FAMILIES = [
    ("apache-1.1", "apache 1 1", "", "apache", rf"{_LICENSE}(?: version)? 1 1"),
    ("apache-2.0", "apache 2 0", "", "apache", rf"(?:{_LICENSE})?(?: version| v)?(?: 2(?: 0)?)"),
    ("apache", "apache", "", "apache", rf"{_LICENSE}"),
    ("mit", "mit", "(?:the )?", "mit", rf"(?:{_LICENSE})"),
    ("mit-0", "mit 0", "", "mit", r"(?: no attribution| 0)(?: license)?"),
    ("x11", "x11", "(?:the )?", "x11", rf"{_LICENSE}"),
    ("expat", "expat", "(?:the )?", "expat", rf"(?:{_LICENSE})?"),
    ("isc", "isc", "(?:the )?", "isc", rf"{_LICENSE}"),
    ("0bsd", "0bsd", "(?:zero clause )", "bsd", rf"(?:{_LICENSE})?"),
    ("bsd-2-clause", "bsd 2 clause", "(?:(?:2|two) clause |simplified )", "bsd", rf"(?:{_LICENSE})?"),
    ("bsd-2-clause", "bsd 2 clause simplified", "", "bsd", r" (?:2|two) clause(?: license)?"),
    ("bsd-3-clause", "bsd 3 clause", "(?:(?:3|three) clause |new |revised |modified )", "bsd", rf"(?:{_LICENSE})?"),
    ("bsd-3-clause", "bsd 3 clause clear", "", "bsd", r" (?:3|three) clause(?: license)?"),
    ("bsd-4-clause", "bsd 4 clause", "(?:(?:4|four) clause |original )", "bsd", rf"(?:{_LICENSE})?"),
    ("bsd", "bsd", "(?:the )?", "bsd", rf"(?: style)?{_LICENSE}"),
    ("gpl-1", "gpl 1 0", "(?:gnu )?(?:general public license |gpl )", "version", r" 1"),
    ("gpl-2", "gpl 2 0", "(?:gnu )?(?:general public license |gpl )(?:as published by the free software foundation )?(?:either )?", "version", r" 2(?: 0)?"),
    ("gpl-3", "gpl 3 0", "(?:gnu )?(?:general public license |gpl )(?:as published by the free software foundation )?(?:either )?", "version", r" 3(?: 0)?"),
    ("gpl-2", "gpl2", "", "gplv2", r"(?: or later|\+)?"),
    ("gpl-3", "gpl3", "", "gplv3", r"(?: or later)?"),
    ("gpl", "gpl", "(?:the )?(?:gnu )?", "general", rf" public licen[sc]e{_VERSION}"),
    ("gpl", "gnu gpl", "(?:the )?(?:gnu )?", "gpl", rf"(?: license)?{_VERSION}"),
    ("lgpl-2.1", "lgpl 2 1", "(?:gnu )?", "lgpl", r"(?: version| v)? 2 1"),
    ("lgpl-3", "lgpl 3 0", "(?:gnu )?", "lgpl", r"(?: version| v)? 3(?: 0)?"),
    ("lgpl", "lgpl", "(?:the )?(?:gnu )?", "lesser", rf" general public licen[sc]e{_VERSION}"),
    ("lgpl", "library gpl", "(?:the )?(?:gnu )?", "library", rf" general public licen[sc]e{_VERSION}"),
    ("lgpl", "gnu lgpl", "(?:the )?(?:gnu )?", "lgpl", rf"{_VERSION}"),
    ("agpl-3", "agpl 3 0", "(?:gnu )?", "agpl", r"(?: version| v)? 3(?: 0)?"),
    ("agpl", "agpl", "(?:the )?(?:gnu )?", "affero", rf" general public licen[sc]e{_VERSION}"),
    ("agpl", "gnu agpl", "(?:the )?(?:gnu )?", "agpl", rf"{_VERSION}"),
    ("gfdl", "gfdl", "(?:the )?(?:gnu )?free ", "documentation", rf" licen[sc]e{_VERSION}"),
    ("mpl-1.1", "mpl 1 1", "", "mozilla", rf"{_LICENSE}(?: version| v)? 1 1"),
    ("mpl-2.0", "mpl 2 0", "", "mozilla", rf"{_LICENSE}(?: version| v)? 2(?: 0)?"),
    ("mpl", "mpl", "(?:the )?", "mozilla", rf"{_LICENSE}"),
    ("epl-1.0", "epl 1 0", "", "eclipse", rf"{_LICENSE}(?: version| v)? 1 0"),
    ("epl-2.0", "epl 2 0", "", "eclipse", rf"{_LICENSE}(?: version| v)? 2 0"),
    ("epl", "epl", "(?:the )?", "eclipse", rf"{_LICENSE}"),
    ("edl", "edl 1 0", "eclipse ", "distribution", r" license(?: version| v)?(?: 1 0)?"),
    ("cddl", "cddl", "(?:the )?", "cddl", rf"{_VERSION}"),
    ("cddl", "cddl 1 0", "(?:common )?development and ", "distribution", rf" license{_VERSION}"),
    ("cpl", "cpl 1 0", "", "common", rf" public license{_VERSION}"),
    ("ibm-public", "ipl 1 0", "", "ibm", rf"{_LICENSE}{_VERSION}"),
    ("artistic-1", "artistic 1 0", "", "artistic", r" license(?: version| v)? 1(?: 0)?"),
    ("artistic-2", "artistic 2 0", "", "artistic", r" license(?: version| v)? 2(?: 0)?"),
    ("artistic", "artistic", "(?:the )?(?:perl )?", "artistic", r" license"),
    ("zlib", "zlib", "(?:the )?", "zlib", r"(?: libpng)?(?: license)"),
    ("libpng", "libpng", "(?:the )?", "libpng", r" license(?: version 2)?"),
    ("openssl", "openssl", "(?:the )?", "openssl", r" license"),
    ("python", "psf 2 0", "(?:the )?", "python", rf"(?: software foundation)?{_LICENSE}"),
    ("ruby", "ruby", "(?:the )?", "ruby", r" license"),
    ("php", "php 3 01", "(?:the )?", "php", rf" license{_VERSION}"),
    ("tcl", "tcl", "(?:the )?", "tcl", r"(?: tk)? license"),
    ("vim", "vim", "(?:the )?", "vim", r" license"),
    ("w3c", "w3c", "(?:the )?", "w3c", r"(?: software)?(?: notice)?(?: and)? license"),
    ("unicode", "unicode dfs 2016", "(?:the )?", "unicode", r"(?: data files and software)? license"),
    ("ncsa", "ncsa", "(?:university of )?illinois ", "ncsa", r"(?: open source)? license"),
    ("upl", "upl 1 0", "", "universal", r" permissive license(?: version| v)?(?: 1 0)?"),
    ("ms-pl", "ms pl", "", "microsoft", r" public license"),
    ("ms-rl", "ms rl", "", "microsoft", r" reciprocal license"),
    ("boost", "bsl 1 0", "(?:the )?", "boost", rf" software license{_VERSION}"),
    ("bsl", "busl 1 1", "(?:the )?", "business", rf" source license{_VERSION}"),
    ("sspl", "sspl 1 0", "(?:the )?", "server", rf" side public license{_VERSION}"),
    ("elastic", "elastic 2 0", "(?:the )?", "elastic", rf" license{_VERSION}"),
    ("eupl", "eupl 1 2", "(?:the )?", "european", rf" union public licen[sc]e{_VERSION}"),
    ("cecill", "cecill", "(?:the )?", "cecill", rf"(?: [bc])?(?: license)?{_VERSION}"),
    ("osl", "osl 3 0", "(?:the )?", "open", rf" software license{_VERSION}"),
    ("afl", "afl 3 0", "(?:the )?", "academic", rf" free license{_VERSION}"),
    ("ofl", "ofl 1 1", "(?:the )?(?:sil )?open ", "font", rf" license{_VERSION}"),
    ("odbl", "odbl 1 0", "(?:the )?open ", "database", rf" license{_VERSION}"),
    ("odc-by", "odc by 1 0", "(?:the )?open data commons ", "attribution", rf" license{_VERSION}"),
    ("pddl", "pddl 1 0", "(?:the )?public domain ", "dedication", r" and license"),
    ("postgresql", "postgresql", "(?:the )?", "postgresql", r" license"),
    ("qpl", "qpl 1 0", "(?:the )?q ", "public", r" license"),
    ("unlicense", "unlicense", "(?:the )?", "unlicense", ""),
    ("wtfpl", "wtfpl", "(?:the )?", "wtfpl", r"(?: version 2)?"),
    ("beerware", "beerware", "(?:the )?", "beerware", r"(?: license)?"),
    ("json", "json", "(?:the )?", "json", r" license"),
    ("cc0", "cc0 1 0", "", "cc0", r"(?: 1 0)?(?: universal)?"),
    ("cc-by", "cc by 4 0", "", "cc", r" by(?: \d 0)?(?: international| unported)?"),
    ("cc-by-sa", "cc by sa 4 0", "", "cc", r" by sa(?: \d 0)?(?: international| unported)?"),
    ("cc-by-nc", "cc by nc 4 0", "", "cc", r" by nc(?: \d 0)?(?: international| unported)?"),
    ("cc-by-nd", "cc by nd 4 0", "", "cc", r" by nd(?: \d 0)?(?: international| unported)?"),
    ("cc-by-nc-sa", "cc by nc sa 4 0", "", "cc", r" by nc sa(?: \d 0)?(?: international| unported)?"),
    ("cc-by-nc-nd", "cc by nc nd 4 0", "", "cc", r" by nc nd(?: \d 0)?(?: international| unported)?"),
    ("cc-by", "creative commons by", "(?:a |the )?", "creative", r" commons attribution(?: \d 0)?(?: international| unported)?(?: license)?"),
    ("cc-by-sa", "creative commons by sa", "(?:a |the )?", "creative", r" commons attribution share ?alike(?: \d 0)?(?: international| unported)?(?: license)?"),
    ("cc-by-nc", "creative commons by nc", "(?:a |the )?", "creative", r" commons attribution non ?commercial(?: \d 0)?(?: international| unported)?(?: license)?"),
    ("cc-by-nd", "creative commons by nd", "(?:a |the )?", "creative", r" commons attribution no ?deriv(?:ative)?s(?: \d 0)?(?: international| unported)?(?: license)?"),
    ("cc-by-nc-sa", "creative commons by nc sa", "(?:a |the )?", "creative", r" commons attribution non ?commercial share ?alike(?: \d 0)?(?: international| unported)?(?: license)?"),
    ("cc-by-nc-nd", "creative commons by nc nd", "(?:a |the )?", "creative", r" commons attribution non ?commercial no ?deriv(?:ative)?s(?: \d 0)?(?: international| unported)?(?: license)?"),
    ("cc", "creative commons", "(?:a |the )?", "creative", r" commons(?: license)"),
    ("public-domain", "public domain", "(?:in(?:to)? )?the public ", "domain", ""),
    ("proprietary", "proprietary", "", "proprietary", r"(?: and confidential| software| information| license)"),
]

#: Rules of notices that name no license: label, words before the keyword, keyword, words after.
NOTICES = [
    ("copyright", "", "copyright", r" (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d){0,199}"),  # there are 200 such years
    ("copyright", "", "copyright", r" (?:c )?by"),
    ("reserved", "all ", "rights", r" reserved"),
    ("reserved", "alle ", "rechte", r" vorbehalten"),
    ("reserved", "tous ", "droits", r" (?:r\S+serv\S+s)"),
    ("reserved", "todos los ", "derechos", r" reservados"),
    ("permissive-text", "", "permission", r" is hereby granted free of charge"),
    ("permissive-text", "", "permission", r" to use copy modify and(?: or)? distribute"),
    ("bsd-text", "", "redistribution", r" and use in source and binary forms"),
    ("no-warranty", "", "warranty", r" of any kind"),
    ("no-warranty", "(?:the )?software is ", "provided", r" as is"),
    ("trademark", "", "trademark", r"s? of"),
    ("patent-grant", "", "patent", r" license to make"),
    ("copyleft-text", "free ", "software", r" you can redistribute it"),
]

_GRANT = (
    r"(?:(?:dual )?(?:licen[sc]ed|released|distributed|available|provided|published|covered|offered|shared)"
    r"(?: to you)?(?: under| by| in accordance with)(?: the)?(?: terms(?: and conditions)? of)?(?: the)? )"
)


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, keyword, expression with the keyword marked, priority, confidence), in order."""
    out = []
    for label, identifier, before, keyword, after in FAMILIES:
        tag = rf"#spdx licen[sc]e identifier {identifier}(?: only| or later)?"
        out.append((label, "spdx", tag, 3, 1.0))
        out.append((label, keyword, rf"{_GRANT}(?:{before})#{keyword}(?:{after})", 3, 0.95))
        out.append((label, keyword, rf"(?:{before})#{keyword}(?:{after})", 2, 0.7))
    for label, before, keyword, after in NOTICES:
        out.append((label, keyword, rf"(?:{before})#{keyword}(?:{after})", 1, 0.5))
    return list(dict.fromkeys(out))


def most_words(expression: str) -> int:
    """The most spaces an expression can match; an error if there is no bound."""

    def most(parsed) -> int:
        total = 0
        for op, value in parsed:
            name = str(op)
            if name == "LITERAL":
                total += value == ord(" ")
            elif name == "MAX_REPEAT":
                once = most(value[2])
                if once and value[1] == re._constants.MAXREPEAT:
                    raise ValueError(f"no bound on the words of {expression}")
                total += once and once * value[1]
            elif name == "SUBPATTERN":
                total += most(value[3])
            elif name == "BRANCH":
                total += max(map(most, value[1]))
            elif name != "IN":  # classes hold no space
                raise ValueError(f"{name} in {expression}")
        return total

    return most(re._parser.parse(expression))


def spans() -> dict[str, tuple[int, int]]:
    """Words before and after each keyword that its rules can match, and so see."""
    out: dict[str, tuple[int, int]] = {}
    for _, keyword, expression, *_ in rules():
        sides = map(most_words, expression.split("#"))
        out[keyword] = tuple(map(max, out.get(keyword, (0, 0)), sides))
    return out


def _count(words: Column) -> Column:
    """Words of a string that joins them by one space; one at the end doesn't count."""
    return F.size(F.split(words, " ")) - 1


def _found(place: Column, words: Column) -> Column:
    """Detections of all rules whose keyword stands at ``place``."""
    sees = {}
    for keyword, (before, after) in spans().items():
        first = F.greatest(place - before, F.lit(0))
        sees[keyword] = first, F.concat_ws(
            " ",
            F.slice(words, first + 1, place - first),
            F.concat(F.lit("#"), F.get(words, place)),
            F.slice(words, place + 2, F.lit(after)),
        )
    by_keyword: dict[str, list[Column]] = {}
    for label, keyword, expression, priority, confidence in rules():
        first, around = sees[keyword]
        # Line separators beyond ASCII are parts of words here, so a dot has to match them too.
        pattern = rf"(?s)^(|.*? )({expression})(?: .*)?\z"
        start = first + _count(F.regexp_extract(around, pattern, 1))
        length = _count(F.concat(F.regexp_extract(around, pattern, 2), F.lit(" ")))
        found = F.struct(
            start.cast("int").alias("start"),
            (-(start + length)).cast("int").alias("minus_end"),
            F.lit(-priority).alias("minus_priority"),
            F.lit(label).alias("label"),
            F.lit(confidence).alias("confidence"),
        )
        by_keyword.setdefault(keyword, []).append(F.when(around.rlike(pattern), found))
    at = F.get(words, place)
    return reduce(
        lambda rest, item: F.when(at == item[0], F.array_compact(F.array(*item[1]))).otherwise(rest),
        by_keyword.items(),
        F.lit(None),
    )


def _kept(found: Column) -> Column:
    """Detections that no other of the same or a higher priority contains."""
    ends = [f"end{p}" for p in (1, 2, 3)]
    none = F.struct(*[F.lit(-1).alias(e) for e in ends], F.filter(found, lambda d: F.lit(False)).alias("kept"))

    def step(state: Column, d: Column) -> Column:
        end, priority = -d.minus_end, -d.minus_priority
        reach = reduce(lambda r, p: F.when(priority == p, state[f"end{p}"]).otherwise(r), (1, 2), state["end3"])
        return F.struct(
            *[
                F.when(priority >= p, F.greatest(state[f"end{p}"], end)).otherwise(state[f"end{p}"]).alias(f"end{p}")
                for p in (1, 2, 3)
            ],
            F.when(reach >= end, state["kept"]).otherwise(F.concat(state["kept"], F.array(d))).alias("kept"),
        )

    return F.aggregate(F.array_sort(F.array_distinct(found)), none, step, lambda state: state["kept"])


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, base, detections) of every row.

    ``base`` holds (start, label) of each place of a base phrase, ``detections`` what the rules keep as
    (start, end, label, priority, confidence); places count words from 0, ends are exclusive.
    """
    # Lower-casing beyond A-Z doesn't move a border between words, nor does it make a base phrase.
    lower = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    words = F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")
    out = df.select(id_col, words.alias("_words"))
    w = F.col("_words")

    phrases = [(phrase.split(), label) for phrase, label in BASE.items()]

    def base_at(word: Column, i: Column) -> Column:
        branch = F.lit(None)
        for phrase, label in phrases:
            here = reduce(
                lambda c, k, phrase=phrase: c & (F.get(w, i + k) == phrase[k]), range(1, len(phrase)), word == phrase[0]
            )
            branch = F.when(here, F.struct(i.cast("long").alias("start"), F.lit(label).alias("label"))).otherwise(branch)
        return branch

    base_words = sorted({max(phrase, key=lambda x: (len(x), x)) for phrase, _ in phrases if "cc" not in phrase} | {"cc"})
    no_base = F.array().cast("array<struct<start:bigint,label:string>>")
    base = F.when(
        F.arrays_overlap(w, F.array(*map(F.lit, base_words))), F.array_compact(F.transform(w, base_at))
    ).otherwise(no_base)

    keywords = sorted({keyword for _, keyword, *_ in rules()})
    places = F.array_compact(F.transform(w, lambda word, i: F.when(word.isin(*keywords), i)))
    kind = "array<struct<start:int,minus_end:int,minus_priority:int,label:string,confidence:double>>"
    found = F.flatten(F.transform(places, lambda place: _found(place, w))).cast(kind)
    kept = F.when(F.arrays_overlap(w, F.array(*map(F.lit, keywords))), _kept(found)).otherwise(F.array().cast(kind))
    detections = F.transform(
        kept,
        lambda d: F.struct(
            d.start.alias("start"),
            (-d.minus_end).alias("end"),
            d.label.alias("label"),
            (-d.minus_priority).alias("priority"),
            d.confidence.alias("confidence"),
        ),
    )
    return out.select(
        id_col,
        F.size(w).cast("long").alias("n_words"),
        base.alias("base"),
        detections.alias("detections"),
    )
