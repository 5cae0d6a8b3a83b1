"""Licence scan by sentence rules.

A text is cut into sentences (line ends, and ends marked by . ! ? ; :), each
is normalised (lower case, everything but letters and digits as one blank) and
looked up in a table of known licence sentences.  A known sentence may be
wrapped: it is also found over consecutive lines, with or without comment
marks before them, but not over a blank line; of those that begin at one
place the longest counts.  The identifiers found, in
the order of the text, are matched against ordered licence rules, each a
sequence of identifiers that must follow one another.  A rule that matches
uses its sentences up, so put specific rules before general ones.  All of it
is one projection of Spark expressions; nothing is shuffled.

Text with licence words in which no rule matches is *unclear* and not allowed.
Null and empty texts have no licences and are allowed.  Rows are judged on their own, so
repeated rows give repeated results; input columns named like a result are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Sentence identifier -> the sentence as licences and notices have it; the table of the SQL. Fixed values.
SHORT_SENTENCES = {
    "apache-under": "Licensed under the Apache License, Version 2.0.",
    "apache-the-license": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-title": "MIT License",
    "bsd-released": "Licensed under the BSD 3-Clause License.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software:",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc0": "This work is dedicated to the public domain under CC0 1.0.",
    "rights": "All rights reserved.",
}


#: Sentences of the bodies and headers of common licences. Fixed values.
BODY_SENTENCES = {
    "agpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
                  "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-copy": "You should have received a copy of the GNU Affero General Public License along with this program.",
    "agpl-title": "GNU Affero General Public License",
    "lgpl-free": "This library is free software;",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "lgpl-copy": "You should have received a copy of the GNU Lesser General Public License along with this library;",
    "lgpl-copy-program": "You should have received a copy of the GNU Lesser General Public License along with this program.",
    "lgpl-title": "GNU Lesser General Public License",
    "lgpl-library-title": "GNU Library General Public License",
    "gpl-title": "GNU General Public License",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2.",
    "mit-granted": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                   'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
                   "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
                   "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                          "that the following conditions are met:",
    "bsd-neither": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                   "products derived from this software without specific prior written permission.",
    "bsd-3-neither": "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission.",
    "isc-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                      "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-permission-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
                          "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "epl2-available": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                      "which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2-title": "Eclipse Public License - v 2.0",
    "epl1-title": "Eclipse Public License - v 1.0",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "apache-title": "Apache License Version 2.0, January 2004",
} | {f"cc-{kind}-{version}": f"Licensed under CC {kind.upper()} {version}."
     for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd") for version in ("1.0", "2.0", "2.5", "3.0", "4.0")
     if (kind, version) not in {("by", "4.0"), ("by-sa", "4.0"), ("by-nc", "4.0")}}
#: Identifier lines of source files -> licence and whether it is allowed. Fixed values.
SPDX = {
    "MIT": ("MIT", True), "Apache-2.0": ("Apache-2.0", True), "BSD-2-Clause": ("BSD", True), "BSD-3-Clause": ("BSD-3-Clause", True),
    "ISC": ("ISC", True), "Unlicense": ("Unlicense", True), "CC0-1.0": ("CC0-1.0", True), "CC-BY-4.0": ("CC-BY-4.0", True),
    "CC-BY-SA-4.0": ("CC-BY-SA-4.0", True), "MPL-2.0": ("MPL-2.0", False), "EPL-2.0": ("EPL-2.0", False),
    "GPL-2.0-only": ("GPL-2.0", False), "GPL-2.0-or-later": ("GPL-2.0", False), "GPL-3.0-only": ("GPL-3.0", False),
    "GPL-3.0-or-later": ("GPL-3.0", False), "LGPL-2.1-only": ("LGPL", False), "LGPL-2.1-or-later": ("LGPL", False),
    "LGPL-3.0-only": ("LGPL", False), "LGPL-3.0-or-later": ("LGPL", False), "AGPL-3.0-only": ("AGPL-3.0", False),
    "AGPL-3.0-or-later": ("AGPL-3.0", False),
}
SENTENCES = SHORT_SENTENCES | BODY_SENTENCES | {f"spdx-{x.lower()}": f"SPDX-License-Identifier: {x}" for x in SPDX}


@dataclass(frozen=True)
class Rule:
    licence: str
    sentences: tuple[str, ...]
    allowed: bool


#: In order of trial; the rules of the SQL.
SHORT_RULES = (
    Rule("Apache-2.0", ("apache-the-license", "apache-comply", "apache-copy"), True),
    Rule("Apache-2.0", ("apache-the-license",), True),
    Rule("Apache-2.0", ("apache-under",), True),
    Rule("GPL", ("gpl-free", "gpl-hope", "gpl-copy"), False),
    Rule("GPL", ("gpl-free",), False),
    Rule("GPL-3.0", ("gpl3-work",), False),
    Rule("MIT", ("mit-title", "mit-released"), True),
    Rule("MIT", ("mit-released",), True),
    Rule("MIT", ("mit-licensed",), True),
    Rule("MIT", ("mit-title",), True),
    Rule("BSD-3-Clause", ("bsd-released",), True),
    Rule("CC-BY-NC-4.0", ("cc-by-nc",), False),
    Rule("CC-BY-SA-4.0", ("cc-by-sa",), True),
    Rule("CC-BY-4.0", ("cc-by",), True),
    Rule("CC0-1.0", ("cc0",), True),
    Rule("proprietary", ("rights",), False),
)

#: AGPL and LGPL notices share sentences with those of the GPL, and 3-clause BSD with 2-clause, so they are tried first.
RULES = (
    Rule("AGPL-3.0", ("gpl-free", "agpl-terms", "gpl-hope", "agpl-copy"), False),
    Rule("AGPL-3.0", ("gpl-free", "agpl-terms"), False),
    Rule("AGPL-3.0", ("gpl-free", "gpl-hope", "agpl-copy"), False),
    Rule("AGPL-3.0", ("agpl-copy",), False),
    Rule("AGPL-3.0", ("agpl-title",), False),
    Rule("LGPL", ("lgpl-free", "lgpl-hope", "lgpl-copy"), False),
    Rule("LGPL", ("gpl-free", "gpl-hope", "lgpl-copy-program"), False),
    *(Rule("LGPL", (x,), False) for x in ("lgpl-free", "lgpl-copy", "lgpl-copy-program", "lgpl-title", "lgpl-library-title")),
    *SHORT_RULES,
    Rule("GPL", ("gpl-copy",), False),
    Rule("GPL", ("gpl-title",), False),
    Rule("GPL-2.0", ("gpl2-work",), False),
    Rule("MIT", ("mit-granted",), True),
    Rule("BSD-3-Clause", ("bsd-redistribution", "bsd-neither"), True),
    Rule("BSD-3-Clause", ("bsd-redistribution", "bsd-3-neither"), True),
    Rule("BSD", ("bsd-redistribution",), True),
    Rule("ISC", ("isc-permission",), True),
    Rule("ISC", ("isc-permission-and",), True),
    *(Rule("MPL-2.0", (x,), False) for x in ("mpl2-subject", "mpl2-title")),
    *(Rule("EPL-2.0", (x,), False) for x in ("epl2-available", "epl2-title")),
    Rule("EPL-1.0", ("epl1-title",), False),
    Rule("Unlicense", ("unlicense",), True),
    Rule("Apache-2.0", ("apache-title",), True),
    *(Rule(x.upper(), (x,), "-nc" not in x and "-nd" not in x) for x in BODY_SENTENCES if x.startswith("cc-")),
    *(Rule(licence, (f"spdx-{x.lower()}",), allowed) for x, (licence, allowed) in SPDX.items()),
)
#: Words of licences and notices: where a text has one but no rule matches, it is not known to be free of licences.
LICENCE_WORDS = "(?i)(?:^|[^a-z0-9_])(?:licen[cs]e[sd]?|copyright|copyleft|spdx)(?:$|[^a-z0-9_])|©"


def normalised(sentence: str) -> str:
    import re

    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip(" ")


def _known() -> dict[str, str]:
    """Normalised sentence -> identifier, the longest first."""
    return dict(sorted(((normalised(s), i) for i, s in SENTENCES.items()), key=lambda x: -len(x[0])))


def _pattern() -> str:
    """Any known sentence from the start of a line to the end of one; a single line feed counts as a blank."""
    return f"(?m)^(?:{'|'.join(s.replace(' ', '[ \n]') for s in _known())})$"


def _sequence(sentences: tuple[str, ...]) -> str:
    """Each identifier has a bar of its own on either side, so that neighbours share none."""
    return "".join(f"|{x}|" for x in sentences)


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    cut = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "([.!?;:])[ \t]+", "$1\n")
    norm = F.trim(F.regexp_replace(F.regexp_replace(cut, "[^a-z0-9\n]+", " "), " ?\n ?", "\n"))
    found = F.regexp_extract_all(norm, F.lit(_pattern()), F.lit(0))
    table = F.create_map(*[F.lit(x) for kv in _known().items() for x in kv])
    return F.transform(found, lambda x: table[F.replace(x, F.lit("\n"), F.lit(" "))])


def matches(ids: Column, rules: tuple[Rule, ...]) -> Column:
    """Indices of the rules that match a sequence of identifiers.

    All places where a rule's sequence stands become marks that no rule
    contains, copies side by side included.
    """
    written = F.array_join(F.transform(ids, lambda x: F.concat(F.lit("|"), x, F.lit("|"))), "")
    start = F.struct(written.alias("left"), F.array().cast("array<int>").alias("found"))
    table = F.array(*[F.struct(F.lit(_sequence(r.sentences)).alias("seq"), F.lit(k).alias("k")) for k, r in enumerate(rules)])
    return F.aggregate(table, start, lambda acc, r: F.when(F.contains(acc["left"], r["seq"]), F.struct(
        F.replace(acc["left"], r["seq"], F.lit("#")).alias("left"), F.concat(acc["found"], F.array(r["k"])).alias("found"))).otherwise(acc),
        lambda acc: acc["found"])


def scan(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with licence_sentences (identifiers), licences (sorted), licence_allowed and licence_unclear.

    licence_unclear: the text has licence words, but no rule matches; such a text is not allowed.
    """
    out = df.withColumn("licence_sentences", identifiers(F.col(f"`{text}`")))
    out = out.withColumn("__rules", F.when(F.size("licence_sentences") > 0, matches(F.col("licence_sentences"), rules)).otherwise(
        F.array().cast("array<int>")))
    names, allowed = F.array(*[F.lit(r.licence) for r in rules]), F.array(*[F.lit(r.allowed) for r in rules])
    return out.withColumns({
        "licences": F.sort_array(F.array_distinct(F.transform("__rules", lambda k: names[k]))),
        "licence_unclear": (F.size("__rules") == 0) & F.coalesce(F.col(f"`{text}`"), F.lit("")).rlike(LICENCE_WORDS),
    }).withColumn("licence_allowed", F.forall("__rules", lambda k: allowed[k]) & ~F.col("licence_unclear")).drop("__rules")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(common.documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.size("licence_sentences").cast("long").alias("n_sentences"),
                      F.array_join("licence_sentences", " ").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"),
                      "licence_allowed", "licence_unclear")


def _sql() -> str:
    """The whole table and rule list in SQL."""
    quoted = {s: i for s, i in _known().items()}
    table = ", ".join(f"'{s}': '{i}'" for s, i in quoted.items())
    steps, last = [], "seqs"
    for k, r in enumerate(RULES):
        seq = _sequence(r.sentences)
        steps.append(f"""r{k} AS (SELECT doc_id, t, ids, replace(rest, '{seq}', '#') AS rest,
  CASE WHEN contains(rest, '{seq}') THEN list_append(lic, '{r.licence}') ELSE lic END AS lic,
  ok AND NOT ({str(not r.allowed).lower()} AND contains(rest, '{seq}')) AS ok FROM {last})""")
        last = f"r{k}"
    return f"""
WITH norm AS (
  SELECT doc_id, coalesce(text, '') AS t,
         trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), '([.!?;:])[ \t]+', '\\1' || chr(10), 'g'),
                                            '[^a-z0-9\n]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), ' ') AS n
  FROM documents),
ids AS (
  SELECT doc_id, t, list_transform(regexp_extract_all(n, '{_pattern()}'), lambda x: MAP {{{table}}}[replace(x, chr(10), ' ')]) AS ids FROM norm),
seqs AS (
  SELECT doc_id, t, ids, array_to_string(list_transform(ids, lambda x: concat('|', x, '|')), '') AS rest, []::VARCHAR[] AS lic, true AS ok FROM ids),
{", ".join(steps)},
u AS (SELECT *, len(lic) = 0 AND regexp_matches(t, '{LICENCE_WORDS}') AS unclear FROM {last})
SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ' ') AS sentence_ids,
       array_to_string(list_sort(list_distinct(lic)), ',') AS licences, ok AND NOT unclear AS licence_allowed, unclear AS licence_unclear
FROM u
"""


SQL = _sql()
