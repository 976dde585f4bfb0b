"""License scan: ordered signature rules over normalised words, in built-in functions only.

A rule is a regular expression on the words that follow one of its keywords. Texts without any
keyword are passed over by one search; elsewhere only the rules of a keyword found are tried,
at the places where it stands. Of nested detections those of lower rank are suppressed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystream.llm.common import let, lower_ascii

#: Anything but digits, letters and characters beyond ASCII stands between words. (Letters of
#: either case, as only texts with a keyword are turned to lower case.)
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words a rule looks at, from its keyword on; no rule spans more.
REACH = 24
#: How sure a detection of each priority is.
CONFIDENCE = {1: 1.0, 2: 0.95, 3: 0.8, 4: 0.6, 5: 0.4}
_TABLE = "map<string, array<struct<expression:string,label:string,priority:int,score:double,rule:int,base:boolean>>>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` starts with the literal ``keyword``; lower ``priority`` wins, then earlier rules."""

    label: str
    keyword: str
    pattern: str
    priority: int
    base: bool = False


#: Phrases and labels that every scan reports, wherever they stand.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Label, name as written in prose, and words of its identifier; all as normalised words.
NAMES = (
    ("mit", "(?:mit|expat|x11)", "mit"),
    ("mit-0", "mit no attribution", "mit 0"),
    ("apache-1.1", "apache (?:software )?(?:license )?(?:version )?1 1", "apache 1 1"),
    ("apache-2.0", "apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?", "apache 2 0"),
    ("apache", "apache(?: software)?", "apache"),
    ("bsd-0-clause", "(?:zero clause bsd|bsd zero clause|0bsd)", "0bsd"),
    ("bsd-2-clause", "(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)", "bsd 2 clause"),
    ("bsd-3-clause", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "(?:original bsd|bsd 4 clause|4 clause bsd)", "bsd 4 clause"),
    ("bsd", "bsd(?: style)?", "bsd"),
    ("isc", "isc", "isc"),
    ("zlib", "(?:zlib libpng|zlib)", "zlib"),
    ("boost-1.0", "boost(?: software)?", "bsl 1 0"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "(?:do what the fuck you want to public|wtfpl)", "wtfpl"),
    ("gpl-1.0", "(?:gnu )?(?:general public license|gpl) ?(?:version |v)?1(?: 0)?", "gpl 1 0"),
    ("gpl-2.0", "(?:gnu )?(?:general public license|gpl) ?(?:version |v)?2(?: 0)?", "gpl 2 0"),
    ("gpl-3.0", "(?:gnu )?(?:general public license|gpl) ?(?:version |v)?3(?: 0)?", "gpl 3 0"),
    ("gpl", "(?:gnu general public|gnu gpl|gpl)", "gpl"),
    ("lgpl-2.0", "(?:gnu )?(?:library general public license|lgpl) ?(?:version |v)?2(?: 0)?", "lgpl 2 0"),
    ("lgpl-2.1", "(?:gnu )?(?:lesser general public license|lgpl) ?(?:version |v)?2 1", "lgpl 2 1"),
    ("lgpl-3.0", "(?:gnu )?(?:lesser general public license|lgpl) ?(?:version |v)?3(?: 0)?", "lgpl 3 0"),
    ("lgpl", "(?:gnu lesser general public|gnu lgpl|lgpl)", "lgpl"),
    ("agpl-3.0", "(?:gnu )?(?:affero general public license|agpl) ?(?:version |v)?3(?: 0)?", "agpl 3 0"),
    ("agpl", "(?:gnu affero general public|affero general public|agpl)", "agpl"),
    ("gfdl-1.3", "(?:gnu )?free documentation license (?:version )?1 3", "gfdl 1 3"),
    ("gfdl", "(?:gnu free documentation|gfdl)", "gfdl"),
    ("mpl-1.1", "(?:mozilla public license|mpl) (?:version |v)?1 1", "mpl 1 1"),
    ("mpl-2.0", "(?:mozilla public license|mpl) (?:version |v)?2(?: 0)?", "mpl 2 0"),
    ("mpl", "(?:mozilla public|mpl)", "mpl"),
    ("epl-1.0", "(?:eclipse public license|epl) (?:version |v)?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "(?:eclipse public license|epl) (?:version |v)?2(?: 0)?", "epl 2 0"),
    ("epl", "(?:eclipse public|epl)", "epl"),
    ("cddl-1.0", "(?:common development and distribution|cddl)", "cddl 1 0"),
    ("cpl-1.0", "common public", "cpl 1 0"),
    ("eupl-1.2", "(?:european union public|eupl)", "eupl 1 2"),
    ("artistic-2.0", "artistic license (?:version )?2(?: 0)?", "artistic 2 0"),
    ("artistic", "artistic", "artistic 1 0"),
    ("perl", "(?:same terms as perl itself|perl artistic)", "artistic 1 0 perl"),
    ("python-2.0", "(?:python software foundation|psf)", "python 2 0"),
    ("php-3.01", "php license (?:version )?3 01", "php 3 01"),
    ("ruby", "ruby", "ruby"),
    ("postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl"),
    ("ofl-1.1", "(?:sil open font|open font|ofl)", "ofl 1 1"),
    ("ms-pl", "(?:microsoft public|ms pl)", "ms pl"),
    ("ms-rl", "(?:microsoft reciprocal|ms rl)", "ms rl"),
    ("odbl-1.0", "(?:open database|odbl)", "odbl 1 0"),
    ("odc-by-1.0", "(?:open data commons attribution|odc by)", "odc by 1 0"),
    ("pddl-1.0", "(?:public domain dedication and license|pddl)", "pddl 1 0"),
    ("cc0-1.0", "(?:creative commons zero|cc0|cc zero)(?: 1 0)?", "cc0 1 0"),
    ("cc-by-nc-nd", "(?:creative commons attribution noncommercial no ?deriv(?:ative)?s|cc by nc nd)(?: [1-4] [05])?", "cc by nc nd 4 0"),
    ("cc-by-nc-sa", "(?:creative commons attribution noncommercial share ?alike|cc by nc sa)(?: [1-4] [05])?", "cc by nc sa 4 0"),
    ("cc-by-nc", "(?:creative commons attribution noncommercial|cc by nc)(?: [1-4] [05])?", "cc by nc 4 0"),
    ("cc-by-nd", "(?:creative commons attribution no ?deriv(?:ative)?s|cc by nd)(?: [1-4] [05])?", "cc by nd 4 0"),
    ("cc-by-sa", "(?:creative commons attribution share ?alike|cc by sa)(?: [1-4] [05])?", "cc by sa 4 0"),
    ("cc-by", "(?:creative commons attribution|cc by)(?: [1-4] [05])?", "cc by 4 0"),
    ("creative-commons", "creative commons", "cc"),
    ("bsl-1.1", "(?:business source|busl)", "busl 1 1"),
    ("elastic-2.0", "elastic license", "elastic 2 0"),
    ("sspl-1.0", "(?:server side public|sspl)", "sspl 1 0"),
    ("openrail", "(?:open responsible ai|openrail)", "openrail"),
    ("llama", "llama (?:2 |3 )?community", "llama2"),
)
#: Lead-ins that make a name a grant of the license.
GRANTS = (
    ("licensed", "licensed under"), ("released", "released under"), ("distributed", "distributed under"),
    ("available", "available under"), ("published", "published under"), ("provided", "provided under"),
    ("covered", "covered by"), ("governed", "governed by"), ("subject", "subject to"), ("terms", "terms of"),
)
#: Signatures without a name from the table.
OTHERS = (
    Rule("public-domain", "public", "public domain(?: dedication)?", 4),
    Rule("public-domain", "placed", "placed (?:in|into) the public domain", 2),
    Rule("public-domain", "dedicated", "dedicated to the public domain", 2),
    Rule("proprietary", "proprietary", "proprietary and confidential", 3),
    Rule("proprietary", "confidential", "confidential and proprietary", 3),
    Rule("proprietary", "unauthorized", "unauthorized (?:copying|use|distribution|reproduction)", 3),
    Rule("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 1),
    Rule("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 1),
    Rule("bsd", "redistribution", "redistribution and use in source and binary forms", 1),
    Rule("bsd", "redistributions", "redistributions of source code must retain the above copyright notice", 2),
    Rule("zlib", "altered", "altered source versions must be plainly marked as such", 2),
    Rule("gpl", "free", "free software you can redistribute it and or modify it under the terms of the gnu general public license", 1),
    Rule("apache-2.0", "apache", "apache org licenses license 2 0", 1),
    Rule("gpl", "gnu", "gnu org (?:licenses|copyleft) gpl", 1),
    Rule("lgpl", "gnu", "gnu org (?:licenses|copyleft) lgpl", 1),
    Rule("creative-commons", "creativecommons", "creativecommons org licenses", 3),
    Rule("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0", 1),
    *(Rule(f"cc-{k}", "creativecommons", f"creativecommons org licenses {k.replace('-', ' ')}", 1)
      for k in ("by-nc-nd", "by-nc-sa", "by-nc", "by-nd", "by-sa", "by")),
    Rule("copyright", "copyright", "copyright (?:c |© )?(?:19|20)[0-9][0-9]", 5),
)


def _first_words(pattern: str) -> list[str]:
    """The words a pattern may start with: those of its leading group, or its first one."""
    if not pattern.startswith("(?:"):
        return [pattern.split(" ")[0].split("(")[0]]
    depth, parts, at = 1, [""], 3
    while depth:
        c = pattern[at]
        depth += (c == "(") - (c == ")")
        if c == "|" and depth == 1:
            parts.append("")
        elif depth:
            parts[-1] += c
        at += 1
    words = [w for x in parts for w in _first_words(x)]
    if pattern[at:at + 1] == "?":  # an optional lead: it, or what may follow
        words += _first_words(pattern[at + 1:])
    return list(dict.fromkeys(words))


def signatures() -> tuple[Rule, ...]:
    """All rules: identifiers, grants and names of each license, then the others and the base."""
    out = []
    for label, name, identifier in NAMES:
        out.append(Rule(label, "spdx", f"spdx license identifier {identifier}", 1))
        out.append(Rule(label, "opensource", f"opensource org licenses? {identifier}", 1))
    for label, name, _ in NAMES:
        for keyword, lead in GRANTS:
            out.append(Rule(label, keyword, f"{lead} (?:the |an? )?(?:terms of the )?(?:gnu )?{name}(?: licen[cs]e)?", 2))
    for label, name, _ in NAMES:
        ends = "" if name[-1] in ")?" and "0" in name[-6:] or name.endswith("license") else " licen[cs]e"
        out += [Rule(label, word, f"{name}{ends}", 3) for word in _first_words(name)]
    out += OTHERS
    out += [Rule(label, phrase.split(" ")[0], phrase, 4, base=True) for phrase, label in BASE_PHRASES]
    return tuple(out)


RULES = signatures()


def expression(rule: Rule) -> str:
    """The rule as an expression on the words from its keyword on; group 1 is what it covers."""
    return f"^({rule.pattern})(?: |$)"


def _gate(keywords: Sequence[str]) -> str:
    """One expression for any keyword as a word, its branches parted by first letter."""
    parted = groupby(sorted(set(keywords)), key=lambda w: w[0])
    return "|".join(f"{c}(?:{'|'.join(w[1:] for w in words)})" for c, words in parted)


def normalised(text: Column) -> Column:
    """The words of a text, one blank between them; "" for null."""
    return F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BETWEEN_WORDS, " "))


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Detections in every whole text: doc_id, n_words, detections, base.

    ``detections`` has start and end (words, from 0, end not included), label, priority, score
    and rule number of what is left after suppression: a detection goes if another of no worse
    priority covers its words, the longer one staying, and of equal ones the earlier rule.
    ``base`` has every place of a base rule, suppressed or not. Both are ordered by start.

    A text that is null, empty or has no word gets no words and empty arrays. Repeated rows are
    scanned each, other columns are ignored. Work on a text grows with its length; places are
    compared only with those that start within the reach of a rule before them.
    """
    keywords = sorted({r.keyword for r in rules})
    gate = _gate(keywords)
    table: dict[str, list[dict]] = {}
    for n, r in enumerate(rules):
        table.setdefault(r.keyword, []).append({
            "expression": expression(r), "label": r.label, "priority": r.priority,
            "score": CONFIDENCE[r.priority], "rule": n, "base": r.base,
        })
    # One literal, folded when the query is planned.
    by_keyword = F.from_json(F.lit(json.dumps(table)), _TABLE)
    n_rules = len(rules)

    def at(words: Column, i: Column) -> Column:
        def tried(context: Column) -> Column:
            return F.filter(F.transform(by_keyword[F.get(words, i)], lambda r: let(
                F.call_function("regexp_extract", context, r["expression"], F.lit(1)),
                lambda found: F.struct(
                    i.alias("start"),
                    (i + F.when(found == "", 0).otherwise(F.length(found) - F.length(F.replace(found, F.lit(" "), F.lit(""))) + 1)).alias("end"),
                    r["priority"].alias("priority"), r["label"].alias("label"), r["score"].alias("score"),
                    r["rule"].alias("rule"), r["base"].alias("base"),
                ))), lambda d: d["end"] > d["start"])

        return let(F.array_join(F.slice(words, i + 1, F.lit(REACH)), " "), tried)

    def detected(words: Column) -> Column:
        places = F.filter(
            F.transform(words, lambda w, i: F.when(w.rlike(f"^(?:{gate})$"), i)), lambda i: i.isNotNull()
        )
        return F.flatten(F.transform(places, lambda i: at(words, i)))

    def kept(found: Column) -> Column:
        def covered(d: Column, k: Column) -> Column:
            # Detections come in order of start, at most one per rule and word, so that no cover
            # of d lies further away in the array than this.
            reach = REACH * n_rules
            near = F.slice(found, F.greatest(k - reach, F.lit(0)) + 1, F.lit(2 * reach + 1))
            return F.exists(near, lambda e: (e["start"] <= d["start"]) & (e["end"] >= d["end"]) & (
                (e["priority"] < d["priority"]) | ((e["priority"] == d["priority"]) & (
                    (e["end"] - e["start"] > d["end"] - d["start"])
                    | ((e["end"] - e["start"] == d["end"] - d["start"]) & (e["rule"] < d["rule"]))))))

        return F.filter(found, lambda d, k: ~covered(d, k))

    norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"))
    padded = F.concat(F.lit(" "), F.col("norm"), F.lit(" "))
    none = "array<struct<start:int,end:int,priority:int,label:string,score:double,rule:int,base:boolean>>"
    found = norm.select(
        "doc_id",
        F.when(F.col("norm") == "", 0).otherwise(
            F.length("norm") - F.length(F.replace(F.col("norm"), F.lit(" "), F.lit(""))) + 1
        ).cast("long").alias("n_words"),
        F.when(padded.rlike(f"(?i) (?:{gate}) "), let(F.split(lower_ascii(F.col("norm")), " "), detected)).otherwise(
            F.array().cast(none)
        ).alias("found"),
    )
    return found.select(
        "doc_id", "n_words", kept(F.col("found")).alias("detections"),
        F.filter("found", lambda d: d["base"]).alias("base"),
    )
