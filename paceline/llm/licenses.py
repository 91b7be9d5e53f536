"""License scans by sentence rules.

Texts are cut into sentences at empty lines and at a full stop, semicolon, colon, ! or ? before white space;
not after ``SPDX-License-Identifier:``, which begins a sentence, and not in ``v. 2.0``. A line end can be a blank
inside a sentence or its border, so wrapped texts and lists of lines are both read. Sentences are normalised
(lower case, only letters, digits, dots and hyphens, single blanks, so marks of comments go) and
looked up among known licence sentences; a usual lead-in (``this project is``) or tail (``see the license file
for details``) is allowed, the longest known sentence counts. In a known sentence ``*`` stands for a name. Of an SPDX
expression each known identifier is found. The identifiers, in order, are matched against rules: a rule is a
sequence of identifiers that has to appear in this order, with other sentences between allowed; a last ``!id``
must not follow before the rule begins anew. Rules stand in an order; a licence is reported once.

All of it are column expressions: no row leaves its task, and known sentences are one pattern and a
fixed table held in the plan.

Defined cases: a null or empty text has no sentences and no licence; repeated rows each get their own
result; other columns are left out unless kept.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.tables import text_of

# Sentences by identifier, and ordered rules over identifiers. The SQL reads these two.
SENTENCES = {
    "apache2-named": "licensed under the apache license version 2.0",
    "apache2-grant": "licensed under the apache license version 2.0 the license",
    "apache2-comply": "you may not use this file except in compliance with the license",
    "apache2-spdx": "spdx-license-identifier apache-2.0",
    "mit-named": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-released": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-spdx": "spdx-license-identifier mit",
    "gpl3-named": "the gnu general public license version 3",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl3-under": "under the terms of the gnu general public license version 3",
    "gpl3-spdx": "spdx-license-identifier gpl-3.0",
    "gpl3-only-spdx": "spdx-license-identifier gpl-3.0-only",
    "gpl3-later-spdx": "spdx-license-identifier gpl-3.0-or-later",
    "ccbync4-named": "licensed under cc by-nc 4.0",
    "ccbysa4-named": "licensed under cc by-sa 4.0",
    "ccby4-named": "licensed under cc by 4.0",
    "cc0-named": "licensed under cc0 1.0",
    "reserved": "all rights reserved",
}
RULES = [
    ("apache-2.0", ["apache2-grant", "apache2-comply"]),
    ("apache-2.0", ["apache2-named"]),
    ("apache-2.0", ["apache2-grant"]),
    ("apache-2.0", ["apache2-spdx"]),
    ("mit", ["mit-grant", "mit-notice"]),
    ("mit", ["mit-title", "mit-grant"]),
    ("mit", ["mit-named"]),
    ("mit", ["mit-released"]),
    ("mit", ["mit-grant"]),
    ("mit", ["mit-spdx"]),
    ("gpl-3.0", ["gpl3-work"]),
    ("gpl-3.0", ["gpl3-under"]),
    ("gpl-3.0", ["gpl3-named"]),
    ("gpl-3.0", ["gpl3-spdx"]),
    ("gpl-3.0", ["gpl3-only-spdx"]),
    ("gpl-3.0", ["gpl3-later-spdx"]),
    ("cc-by-nc-4.0", ["ccbync4-named"]),
    ("cc-by-sa-4.0", ["ccbysa4-named"]),
    ("cc-by-4.0", ["ccby4-named"]),
    ("cc0-1.0", ["cc0-named"]),
    ("all-rights-reserved", ["reserved"]),
]


# Sentences of the licences' own texts and notices: each tells its licence.
_FSF = "as published by the free software foundation"
_MODIFY = "you can redistribute it and or modify it under the terms of the"
_ANY = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
_ISC = "software for any purpose with or without fee is hereby granted"
_APPEAR = "provided that the above copyright notice and this permission notice appear in all copies"
_SELL = "neither the name of * may be used to endorse or promote products derived from this software without specific prior written permission"
_GNU = {
    "gpl-2.0": ("general", "2", "june 1991"), "gpl-3.0": ("general", "3", "29 june 2007"), "lgpl-2.1": ("lesser general", "2.1", "february 1999"),
    "lgpl-3.0": ("lesser general", "3", "29 june 2007"), "agpl-3.0": ("affero general", "3", "19 november 2007"),
}
_TEXTS: dict[str, list[str]] = {
    "mit": ["mit license", "the mit license mit", f"{_ANY} subject to the following conditions"],
    "mit-0": ["mit no attribution", _ANY],
    "apache-2.0": [
        "apache license version 2.0 january 2004",
        "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non-exclusive no-charge royalty-free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form",
    ],
    "isc": ["isc license", "the isc license"] + [f"permission to use copy modify {x} distribute this {_ISC} {_APPEAR}" for x in ("and or", "and")],
    "0bsd": ["bsd zero clause license", "zero-clause bsd"] + [f"permission to use copy modify and or distribute this {_ISC}"],
    "bsd-2-clause": ["bsd 2-clause license", "the 2-clause bsd license", "simplified bsd license"],
    "bsd-3-clause": ["bsd 3-clause license", "the 3-clause bsd license", "new bsd license"],
    "mpl-2.0": [
        "mozilla public license version 2.0",
        *[f"this source code form is subject to the terms of the mozilla public license {v}" for v in ("v 2.0", "v2.0", "version 2.0")],
        "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0",
        "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0",
    ],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "cc0-1.0": ["cc0 1.0 universal", "creative commons cc0 1.0 universal"],
    "cc-by-4.0": ["creative commons attribution 4.0 international public license", "attribution 4.0 international"],
    "cc-by-sa-4.0": ["creative commons attribution-sharealike 4.0 international public license", "attribution-sharealike 4.0 international"],
    "cc-by-nc-4.0": ["creative commons attribution-noncommercial 4.0 international public license", "attribution-noncommercial 4.0 international"],
}
for _name, (_kind, _version, _day) in _GNU.items():
    _full = f"gnu {_kind} public license"
    _TEXTS[_name] = [f"{_full} version {_version} {_day}"] + [f"{_MODIFY} {_full} {_FSF} {x}" for x in (
        f"either version {_version} of the license or at your option any later version", f"version {_version} of the license", f"version {_version}")]
# As others name them, after "licensed under", "under the terms of" and the like.
_NAMES: dict[str, list[str]] = {
    "mit": ["mit license", "mit licence", "mit"], "apache-2.0": ["apache license version 2.0", "apache license 2.0", "apache 2.0 license", "apache-2.0 license", "apache 2.0"],
    "isc": ["isc license"], "mpl-2.0": ["mozilla public license version 2.0", "mozilla public license 2.0", "mozilla public license v 2.0", "mpl 2.0", "mpl-2.0"],
    "bsd-2-clause": ["bsd 2-clause license", "2-clause bsd license", "bsd-2-clause license", "simplified bsd license"],
    "bsd-3-clause": ["bsd 3-clause license", "3-clause bsd license", "bsd-3-clause license", "new bsd license"], "unlicense": ["unlicense"],
    "cc0-1.0": ["cc0 1.0", "cc0 1.0 universal"],
}
_NAMES |= {
    f"cc-{x}-4.0": [f"cc {x} 4.0", f"cc-{x}-4.0", *[f"creative commons {long} 4.0 {end}".strip() for end in ("", "license", "international", "international license")]]
    for x, long in (("by", "attribution"), ("by-sa", "attribution-sharealike"), ("by-nc", "attribution-noncommercial"))
}
for _name, (_kind, _version, _day) in _GNU.items():
    _short, _whole = _name.split("-")[0], f"gnu {_kind} public license"
    _NAMES[_name] = [
        *[f"{x} {end}" for x in (_whole, f"{_whole} {_short}", f"gnu {_short}", _short) for end in (f"version {_version}", f"v{_version}", f"v {_version}", f"{_version}")],
        f"{_whole} version {_version} or later", f"{_whole} version {_version} or any later version", f"{_short}v{_version}", f"{_short}-{_version}"]
_VERBS = ("licensed under", "released under", "distributed under", "available under", "published under", "provided under", "covered by", "under the terms of",
          "licensed under the terms of", "released under the terms of", "distributed under the terms of")
TAG, UNDER = "spdx-license-identifier", "licensed under "
_SPDX = ["mit", "mit-0", "apache-2.0", "isc", "0bsd", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause", "mpl-2.0", "unlicense", "cc0-1.0", "cc-by-4.0", "cc-by-sa-4.0", "cc-by-nc-4.0",
         *[x + end for x in _GNU for end in ("", "-only", "-or-later")]]


def _texts() -> tuple[dict[str, list[str]], list[tuple[str, list[str]]]]:
    kinds = {"text": _TEXTS, "by-name": {name: [f"{UNDER}{x}" for x in many] for name, many in _NAMES.items()}, "spdx-id": {}}
    for spdx in _SPDX:
        kinds["spdx-id"].setdefault(re.sub("-only$|-or-later$", "", spdx), []).append(f"{TAG} {spdx}")
    known = {f"{name}-{kind}": [x for x in many if x not in SENTENCES.values()] for kind, table in kinds.items() for name, many in table.items()}
    return known, [(name, [f"{name}-{kind}"]) for kind, table in kinds.items() for name in table]


TEXTS, TEXT_RULES = _texts()
TEXTS |= {
    "mit-notice-next": ["the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"],
    "bsd-use": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-advertising": ["all advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "bsd-endorse": [_SELL],
    "bsd-endorse-name": ["the name of * may not be used to endorse or promote products derived from this software without specific prior written permission"],
}
TEXT_RULES += [
    ("bsd-4-clause", ["bsd-use", "bsd-advertising"]),
    ("bsd-3-clause", ["bsd-use", "bsd-endorse", "!bsd-advertising"]),
    ("bsd-3-clause", ["bsd-use", "bsd-endorse-name", "!bsd-advertising"]),
    ("bsd-2-clause", ["bsd-use", "bsd-source", "!bsd-endorse", "!bsd-endorse-name", "!bsd-advertising"]),
]
ALL_SENTENCES, ALL_RULES = {name: [x] for name, x in SENTENCES.items()} | TEXTS, RULES + TEXT_RULES

# Marks in a normalised text: S ends a sentence, L a line; two L end a paragraph.
_SEP = "(?: ?L ?| )"
_LEAD = (f"(?:(?:(?:this|the|these|all|our|its)[a-z0-9. -]*?(?:L[a-z0-9. -]*?)??{_SEP})?(?:is|are)(?:{_SEP}(?:also|hereby))?{_SEP}"
         f"|(?:dual|you{_SEP}may{_SEP}use{_SEP}it){_SEP})")
_TAIL = f"(?:{_SEP}(?:please{_SEP})?see(?:{_SEP}the)?(?:{_SEP}(?:accompanying|file|licen[cs]e[a-z0-9.-]*|copying)){{1,4}}(?:{_SEP}for(?:{_SEP}(?:more|full))?{_SEP}(?:details|information))?)"
# Loops go over characters, not groups: Java's groups recurse, and a document can be one line.
_EXPRESSION, _ANYTHING = f"{TAG} [a-z0-9. -]+", "[a-z0-9.S -]+?" + "(?:L[a-z0-9.S -]*?)??" * 3


def _trie(known: Sequence[str]) -> str:
    """A pattern of all known sentences that prefers longer ones."""

    def branch(tails: list[list[str]]) -> str:
        heads: dict[str, list[list[str]]] = {}
        for words in tails:
            if words:
                heads.setdefault(words[0], []).append(words[1:])
        parts = [(_ANYTHING if w == "*" else re.escape(w).replace(r"\-", "-")) + after(rest) for w, rest in heads.items()]
        return "(?:" + "|".join(parts) + ")"

    def after(tails: list[list[str]]) -> str:
        more = [t for t in tails if t]
        return "" if not more else f"(?:{_SEP}{branch(more)})" + ("?" if len(more) < len(tails) else "")

    return branch([s.split() for s in known])


def normalised(text: Column) -> Column:
    """The text between marks."""
    marked = F.regexp_replace(F.lower(text), rf"{TAG}[ \t]*:[ \t]*", f"S {TAG} ")
    marked = F.regexp_replace(marked, r"(?!(?<=\bv)\.\s\d)[.;:!?](?=\s|$)", "S")
    words = F.regexp_replace(F.regexp_replace(marked, r"\r\n?|\n", "L"), "[^a-z0-9.SL-]+", " ")
    return F.concat(F.lit("L"), F.regexp_replace(words, r"\.+(?=[ SL]|$)|(?<![a-z0-9.-])-+(?: |(?=[SL]|$))", ""), F.lit("L"))


def identifiers(text: Column, known: Mapping[str, Sequence[str]] = ALL_SENTENCES) -> Column:
    """Identifiers of the known sentences in order of appearance."""
    pairs = [(sentence, name) for name, many in known.items() for sentence in many]
    table = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    verb, names = f"{_trie(_VERBS)}{_SEP}(?:the{_SEP})?", [x[len(UNDER):] for x, _ in pairs if x.startswith(UNDER)]
    one = "(?:" + "|".join([_trie([x for x, _ in pairs]), *([verb + _trie(names)] if names else [])]) + ")"
    end = "(?=(?: ?[SL]))"
    found = F.regexp_extract_all(normalised(text), F.lit(
        rf"(?<=[SL] ?)(?<!\bnot ?L ?)(?:{_EXPRESSION}{end}|{one}{end}|{_LEAD}?{one}{_TAIL}?{end})"), F.lit(0))

    def ids(match: Column) -> Column:
        plain = F.trim(F.regexp_replace(match, "[ SL]+", " "))
        bare = F.regexp_extract(plain, f"^{_LEAD}?({one}){_TAIL}?$", 1)
        by_name = [F.when(bare.rlike("^" + re.escape(s).replace(r"\ ", " ").replace(r"\-", "-").replace(r"\*", ".+") + "$"), F.lit(i)) for s, i in pairs if "*" in s]
        standard = F.regexp_replace(bare, f"^{verb}", UNDER)
        parts = F.transform(F.split(F.regexp_replace(plain, f"^{TAG} ", ""), " (?:or|and|with) ", -1), lambda x: table[F.concat(F.lit(f"{TAG} "), F.substring_index(x, " ", 1))])
        return F.when(plain.startswith(f"{TAG} "), parts).otherwise(F.array(F.coalesce(table[plain], table[bare], table[standard], *by_name)))

    return F.filter(F.flatten(F.transform(found, ids)), lambda i: i.isNotNull())


def _fits(found: Column, ids: Sequence[str]) -> Column:
    """Do ``ids`` appear in this order, and those with ``!`` not before the first comes again?"""
    line = F.concat(F.lit(" "), F.array_join(found, "  "), F.lit(" "))
    wanted, barred = [i for i in ids if not i.startswith("!")], [i[1:] for i in ids if i.startswith("!")]
    if not barred:
        return line.like("%" + "%".join(f" {i} " for i in wanted) + "%")
    word = lambda i: f" {re.escape(i)} ".replace(r"\-", "-")
    inside = f"(?:(?!{word(wanted[0])}).)*?"
    first = word(wanted[0]) + "".join(f"(?!{inside}{word(i)})" for i in barred)
    return line.rlike(first + "".join(inside + word(i) for i in wanted[1:]))


def scan(
    docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",),
    known: Mapping[str, Sequence[str]] = ALL_SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = ALL_RULES,
) -> DataFrame:
    """Per row: ``keep``, ``sentence_ids`` (in order), ``licenses`` (in the order of the rules)."""
    found = docs.select(*keep, identifiers(text_of(text), known).alias("sentence_ids"))
    hits = F.array(*[F.when(_fits(F.col("sentence_ids"), ids), F.lit(name)) for name, ids in rules])
    return found.withColumn("licenses", F.when(
        F.size("sentence_ids") > 0, F.array_distinct(F.filter(hits, lambda x: x.isNotNull()))
    ).otherwise(F.array().cast("array<string>")))
