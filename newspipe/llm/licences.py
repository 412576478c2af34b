"""Licence recognition by sentence rules, in column expressions only.

A text is cut into sentences, each is normalised and looked up among known licence
sentences, and the identifiers in order are matched against ordered rules: a rule fires
where its identifiers stand next to each other, consumes them, and what is left goes on to
later rules. Longer rules come first. Identifiers that no rule consumes are reported, not
dropped, and an unknown sentence that speaks of licences stands between its neighbours.

A line break ends a sentence, and alternatively is a blank (wrapped text); rules see both
readings. ``licences`` has each licence once, in the order of the rules.

Null and empty texts have no sentence and no licence. Very long texts are read whole.
Repeated rows are reported each. An empty table gives an empty result. Columns other than
``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences as normalised text (lower case, only letters
# and digits, single blanks), by identifier.
SENTENCES = {
    "mit-released": ["released under the mit license"],
    "mit-licensed": [
        "licensed under the mit license",
        "this project is licensed under the mit license",
        "this software is released under the mit license",
        "distributed under the mit license",
    ],
    "mit-title": ["the mit license", "mit license", "the mit license mit"],
    "mit-grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files the software to deal in the software"
        " without restriction including without limitation the rights to use copy modify merge"
        " publish distribute sublicense and or sell copies of the software and to permit persons"
        " to whom the software is furnished to do so subject to the following conditions",
    ],
    "mit-notice": [
        "the above copyright notice and this permission notice shall be included in all copies"
        " or substantial portions of the software",
    ],
    "as-is-software": [
        "the software is provided as is without warranty of any kind express or implied including"
        " but not limited to the warranties of merchantability fitness for a particular purpose"
        " and noninfringement",
    ],
    "as-is-liable": [
        "in no event shall the authors or copyright holders be liable for any claim damages or other"
        " liability whether in an action of contract tort or otherwise arising from out of or in"
        " connection with the software or the use or other dealings in the software",
    ],
    "apache2-licensed": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license",
        "this project is licensed under the apache license version 2 0",
    ],
    "apache2-may-not-use": [
        "you may not use this file except in compliance with the license",
    ],
    "apache2-obtain": [
        "you may obtain a copy of the license at",
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
    ],
    "free-software": ["this program is free software", "this library is free software"],
    "gpl-no-warranty": [
        "this program is distributed in the hope that it will be useful but without any warranty",
        "this library is distributed in the hope that it will be useful but without any warranty",
    ],
    "gnu-implied": [
        "without even the implied warranty of merchantability or fitness for a particular purpose",
    ],
    "bsd-permitted": [
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
    ],
    "bsd-source": [
        "redistributions of source code must retain the above copyright notice this list of"
        " conditions and the following disclaimer",
    ],
    "bsd-binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of"
        " conditions and the following disclaimer in the documentation and or other materials"
        " provided with the distribution",
    ],
    "bsd-names": [
        "neither the name of x nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
    ],
    "bsd-advertising": [
        "all advertising materials mentioning features or use of this software must display the"
        " following acknowledgement",
    ],
    "bsd-includes": ["this product includes software developed by x"],
    "bsd-disclaimer": [
        "this software is provided by the copyright holders and contributors as is and any express"
        " or implied warranties including but not limited to the implied warranties of"
        " merchantability and fitness for a particular purpose are disclaimed",
    ],
    "bsd-licensed": ["licensed under the bsd license", "released under the bsd license"],
    "isc-grant": [
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted provided that the above copyright notice and this"
        " permission notice appear in all copies",
    ],
    "mpl2-subject": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ],
    "mpl2-obtain": [
        "if a copy of the mpl was not distributed with this file you can obtain one at"
        " http mozilla org mpl 2 0",
        "if a copy of the mpl was not distributed with this file you can obtain one at"
        " https mozilla org mpl 2 0",
    ],
    "cc-by": ["licensed under cc by 4 0"],
    "cc-by-sa": ["licensed under cc by sa 4 0"],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "cc-by-nc-sa": ["licensed under cc by nc sa 4 0"],
    "cc-by-nd": ["licensed under cc by nd 4 0"],
    "cc0": ["licensed under cc0 1 0", "released under cc0 1 0"],
    "unlicense": [
        "this is free and unencumbered software released into the public domain",
    ],
    "all-rights": ["all rights reserved"],
}

# Families of sentences that differ in a name or a version only, by rule.
_GNU = {"gpl": "general", "lgpl": "lesser general", "agpl": "affero general"}
_GNU_VERSIONS = [
    ("gpl", "2", "2"), ("gpl", "3", "3"), ("lgpl", "21", "2 1"), ("lgpl", "3", "3"), ("agpl", "3", "3"),
]
_CC = {
    "by": "attribution",
    "by-sa": "attribution sharealike",
    "by-nd": "attribution noderivatives",
    "by-nc": "attribution noncommercial",
    "by-nc-sa": "attribution noncommercial sharealike",
    "by-nc-nd": "attribution noncommercial noderivatives",
}
# Identifiers of the SPDX list that files are tagged with.
_SPDX = (
    "MIT Apache-2.0 0BSD BSD-2-Clause BSD-3-Clause BSD-4-Clause GPL-2.0-only GPL-2.0-or-later"
    " GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later"
    " AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 ISC CC-BY-4.0 CC-BY-SA-4.0 CC0-1.0 Unlicense Zlib"
    " BSL-1.0 EPL-2.0"
).split()


def _gnu_name(kind: str, version: str) -> str:
    return f"{kind.upper()}-{version.replace(' ', '.') if ' ' in version else version + '.0'}"


for _kind, _id, _version in _GNU_VERSIONS:
    _license = f"the gnu {_GNU[_kind]} public license"
    _published = "as published by the free software foundation"
    _leads = ("", "this program is free software ", "this library is free software ")
    _terms = "you can redistribute it and or modify it under the terms of"
    SENTENCES[f"{_kind}{_id}-work"] = [
        f"{lead}licensed under {_license} version {_version}"
        for lead in ("", "this work is ", "this program is ")
    ]
    SENTENCES[f"{_kind}{_id}-or-later"] = [
        f"{lead}{_terms} {_license} {_published} either version {_version} of the license or at your"
        " option any later version"
        for lead in _leads
    ]
    SENTENCES[f"either-{_id}-or-later"] = [
        f"either version {_version} of the license or at your option any later version"
    ]
    SENTENCES[f"{_kind}-terms"] = [f"{lead}{_terms} {_license} {_published}" for lead in _leads]
    SENTENCES[f"{_kind}{_id}-only"] = [
        f"{lead}{_terms} {_license} version {_version} {_published}" for lead in _leads
    ]
for _kind, _words in _GNU.items():
    _license = f"the gnu {_words} public license"
    SENTENCES[f"{_kind}-see"] = [f"see {_license} for more details"]
    SENTENCES[f"{_kind}-received"] = [
        f"you should have received a copy of {_license} along with this {what}"
        for what in ("program", "library")
    ]
for _kind, _words in _CC.items():
    SENTENCES.setdefault(f"cc-{_kind}", [f"licensed under cc {_kind.replace('-', ' ')} 4 0"])
    SENTENCES[f"cc-{_kind}"] += [
        f"{lead}licensed under {article} creative commons {_words} 4 0 international license"
        for lead in ("", "this work is ")
        for article in ("a", "the")
    ]
for _name in _SPDX:
    _plain = _name.lower().replace("-", " ").replace(".", " ")
    SENTENCES[f"spdx-{_name}"] = [f"spdx license identifier {_plain}"]


def _gnu_rules() -> list[tuple[str, list[str]]]:
    """The notices of each version, the whole one before its parts."""
    rules = []
    for kind, number, version in _GNU_VERSIONS:
        warranty = ["gpl-no-warranty", "gnu-implied", f"{kind}-see", f"{kind}-received"]
        cores = {
            "or-later": [[f"{kind}{number}-or-later"], [f"{kind}-terms", f"either-{number}-or-later"]],
            "only": [[f"{kind}{number}-only"]],
        }
        for what, spelled in cores.items():
            name = f"{_gnu_name(kind, version)}-{what}"
            for core in spelled:
                for lead in (["free-software"], []):
                    rules += [(name, [*lead, *core, *warranty[:n]]) for n in (4, 3, 2, 1, 0)]
    return sorted(rules, key=lambda r: -len(r[1]))


# Licences and the identifiers that show them, tried in this order.
RULES = [
    ("MIT", ["mit-title", "mit-grant", "mit-notice", "as-is-software", "as-is-liable"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is-software", "as-is-liable"]),
    ("BSD-4-Clause", ["bsd-permitted", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-includes", "bsd-names", "bsd-disclaimer"]),
    ("BSD-4-Clause", ["bsd-permitted", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-includes", "bsd-names"]),
    ("BSD-3-Clause", ["bsd-permitted", "bsd-source", "bsd-binary", "bsd-names", "bsd-disclaimer"]),
    ("BSD-3-Clause", ["bsd-permitted", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-permitted", "bsd-source", "bsd-binary", "bsd-disclaimer"]),
    ("MIT", ["mit-title", "mit-grant", "mit-notice", "as-is-software"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is-software"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("BSD-2-Clause", ["bsd-permitted", "bsd-source", "bsd-binary"]),
    ("BSD-1-Clause", ["bsd-permitted", "bsd-source"]),
    ("Apache-2.0", ["apache2-licensed", "apache2-may-not-use", "apache2-obtain"]),
    ("Apache-2.0", ["apache2-licensed", "apache2-may-not-use"]),
    *_gnu_rules(),
    ("MPL-2.0", ["mpl2-subject", "mpl2-obtain"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("ISC", ["isc-grant", "as-is-software"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache2-licensed"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-title"]),
    *[(f"{_gnu_name(kind, version)}-only", [f"{kind}{number}-work"]) for kind, number, version in _GNU_VERSIONS],
    ("BSD", ["bsd-licensed"]),
    *[(f"CC-{kind.upper()}-4.0", [f"cc-{kind}"]) for kind in reversed(_CC)],
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    *[(name, [f"spdx-{name}"]) for name in _SPDX],
]

# Every known sentence has one of these; a text without them is not cut into sentences.
HINT = (
    r"(?i)licen[sc]e|permission|redistribut|warrant|rights[^a-z0-9]+reserved|unencumbered|cc0|mozilla"
    r"|free[^a-z0-9]+software|advertising|software[^a-z0-9]+developed|mpl|in[^a-z0-9]+no[^a-z0-9]+event"
)
ENDS = r"[.!?;:]+[\"')]*[ \t\r]+"
# An empty line ends a sentence, a single line end may not.
PARAGRAPH = r"\n[ \t\r*#/]*\n"
# A tag goes on behind its colon.
TAG = r"(?i)(spdx-license-identifier):[ \t]*"
# What differs from text to text: names, within a sentence.
NAMED = [
    (r"^neither the name of .+ nor the names of (?:its|the) contributors may", "neither the name of x nor the names of its contributors may"),
    (r"^this product includes software developed by .+$", "this product includes software developed by x"),
]
# An unknown sentence with such a word may be part of a licence, so no rule reaches over it.
LIKELY = r"licen[sc]e|redistribut|permission|warrant|liable|endorse"
UNKNOWN = "?"


def _identifiers(sentences: Column) -> Column:
    """The sentences that count, as identifiers in order; unknown ones as ``?``."""
    # One literal, which the optimizer folds into a map.
    pairs = "|".join(f"{text}={name}" for name, texts in SENTENCES.items() for text in texts)
    known = F.str_to_map(F.lit(pairs), F.lit("[|]"), F.lit("="))

    def plain(sentence: Column) -> Column:
        text = F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))
        return reduce(lambda t, n: F.regexp_replace(t, *n), NAMED, text)

    found = F.transform(
        F.transform(sentences, plain),
        lambda s: F.coalesce(F.try_element_at(known, s), F.when(s.rlike(LIKELY), UNKNOWN)),
    )
    return F.filter(found, lambda s: s.isNotNull())


def _sequence(sentences: Column) -> Column:
    """Identifiers as text, each with its own delimiters: ``,a,,b,``. Empty if none is known."""
    ids = _identifiers(sentences)
    told = F.array_join(F.transform(ids, lambda s: F.concat(F.lit(","), s, F.lit(","))), "")
    return F.when(F.regexp_replace(told, r"[,?]+", "") != "", told).otherwise("")


def _matched(sequence: Column) -> Column:
    """What the rules find in a sequence, and what no rule consumes."""
    start = F.struct(sequence.alias("left"), F.expr("cast(array() as array<string>)").alias("found"))
    rules = F.split(F.lit("|".join(f"{name}={_ids(ids)}" for name, ids in RULES)), "[|]")

    def apply(state: Column, rule: Column) -> Column:
        # "|" marks where sentences were taken out, so that none beside it become neighbours.
        left = F.replace(state["left"], F.substring_index(rule, "=", -1), F.lit("|"))
        name = F.substring_index(rule, "=", 1)
        return F.struct(
            left.alias("left"),
            F.when(left != state["left"], F.array_union(state["found"], F.array(name)))
            .otherwise(state["found"])
            .alias("found"),
        )

    return F.aggregate(rules, start, apply)


def scan_licences(docs: DataFrame) -> DataFrame:
    """``doc_id, n_known, sentence_ids, licences, unmatched`` of every document.

    ``sentence_ids`` and ``unmatched`` are identifiers joined by commas, from the reading
    in which more sentences are known (lines, if equal); ``licences`` joins what the rules
    find in either. In ``unmatched`` a ``?`` is an unknown sentence that speaks of licences.
    """
    hinted = F.when(F.col("text").rlike(HINT), F.regexp_replace("text", TAG, "$1 "))
    by_line = F.split(F.regexp_replace(hinted, ENDS, "\n"), "\n")
    flat = F.regexp_replace(F.regexp_replace(hinted, PARAGRAPH, "; "), r"[\n*#/]+", " ")
    by_flow = F.split(F.regexp_replace(flat, ENDS, "\n"), "\n")
    empty = F.lit("")
    rows = docs.select(
        "doc_id",
        F.coalesce(_sequence(by_line), empty).alias("lines"),
        F.coalesce(_sequence(by_flow), empty).alias("flow"),
    ).select(
        "doc_id",
        "lines",
        "flow",
        F.when((F.col("lines") != "") | (F.col("flow") != ""), _matched(F.col("lines"))).alias("m1"),
        F.when((F.col("flow") != "") & (F.col("flow") != F.col("lines")), _matched(F.col("flow"))).alias("m2"),
    )
    count = lambda c: F.size(F.array_remove(F.split(c, r"[,?]+"), ""))
    more = count("flow") > count("lines")
    none = F.expr("cast(array() as array<string>)")
    plain = lambda c, ends: F.array_join(F.array_remove(F.split(c, ends), ""), ",")
    found = F.array_union(F.coalesce("m1.found", none), F.coalesce("m2.found", none))
    order = list(dict.fromkeys(name for name, _ in RULES))
    in_order = F.filter(F.array(*map(F.lit, order)), lambda name: F.array_contains(found, name))
    return rows.select(
        "doc_id",
        F.greatest(count("lines"), count("flow")).cast("long").alias("n_known"),
        plain(F.when(more, F.col("flow")).otherwise(F.col("lines")), r"[,?]+").alias("sentence_ids"),
        F.array_join(in_order, ",").alias("licences"),
        F.coalesce(
            plain(F.when(more, F.col("m2.left")).otherwise(F.col("m1.left")), "[,|]+"), empty
        ).alias("unmatched"),
    )


def oracle_sql(table: str) -> str:
    """The same in DuckDB's SQL, with the rules as one chain of replacements."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    keys = ", ".join(quoted(t) for texts in SENTENCES.values() for t in texts)
    names = ", ".join(quoted(n) for n, texts in SENTENCES.items() for _ in texts)

    def sequence(text: str) -> str:
        parts = f"string_split(regexp_replace({text}, {quoted(ENDS)}, chr(10), 'g'), chr(10))"
        plain = "trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))"
        for pattern, name in NAMED:
            plain = f"regexp_replace({plain}, {quoted(pattern)}, {quoted(name)})"
        found = f"coalesce(known[s], case when regexp_matches(s, {quoted(LIKELY)}) then '?' end)"
        ids = f"[i for i in [{found} for s in [{plain} for s in {parts}]] if i is not null]"
        return f"coalesce(array_to_string([',' || i || ',' for i in {ids}], ''), '')"

    def left(column: str) -> str:
        # Each rule leaves its number where it took sentences out.
        return reduce(lambda e, r: f"replace({e}, {quoted(_ids(r[1][1]))}, '|#{r[0]}|')", enumerate(RULES), column)

    rules = ", ".join(quoted(name) for name, _ in RULES)
    fired = lambda c: f"[n for n, k in [{rules}] if contains({c}, '#' || (k - 1) || '|')]"
    order = ", ".join(map(quoted, dict.fromkeys(name for name, _ in RULES)))
    plain = lambda c, ends: f"array_to_string([x for x in regexp_split_to_array({c}, '{ends}') if x <> ''], ',')"
    count = lambda c: f"len([x for x in regexp_split_to_array({c}, '[,?]+') if x <> ''])"
    told = lambda c: f"case when regexp_replace({c}, '[,?]+', '', 'g') <> '' then {c} else '' end"
    flat = f"regexp_replace(regexp_replace(text, {quoted(PARAGRAPH)}, '; ', 'g'), '[\\n*#/]+', ' ', 'g')"
    return f"""
    with ids as (select map([{keys}], [{names}]) as known),
    hinted as (select doc_id, case when regexp_matches(text, {quoted(HINT)})
        then regexp_replace(text, {quoted(TAG)}, '\\1 ', 'g') end as text from {table}),
    counted as (select doc_id, case when text is null then '' else {sequence("text")} end as lines,
        case when text is null then '' else {sequence(flat)} end as flow from hinted, ids),
    sequences as (select doc_id, {told("lines")} as lines, {told("flow")} as flow from counted),
    hits as (select * from sequences where lines <> '' or flow <> ''),
    taken as (select *, {left("lines")} as l1, {left("flow")} as l2 from hits),
    matched as (select *, {fired("l1")} || {fired("l2")} as f from taken),
    results as (select doc_id, greatest({count("lines")}, {count("flow")})::bigint as n_known,
        {plain(f"case when {count('flow')} > {count('lines')} then flow else lines end", "[,?]+")} as sentence_ids,
        array_to_string([n for n in [{order}] if list_contains(f, n)], ',') as licences,
        {plain(f"case when {count('flow')} > {count('lines')} then l2 else l1 end", "[,|]+(#[0-9]+[,|]+)*")} as unmatched from matched)
    select * from results
    union all
    select doc_id, 0::bigint, '', '', '' from sequences where lines = '' and flow = ''
    """


def _ids(ids: list[str]) -> str:
    return "".join(f",{i}," for i in ids)
