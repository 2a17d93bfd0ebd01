"""Licence scans by sentence rules, as DataFrame expressions only.

A text is cut into sentences, each is normalised (lower case, only a-z and 0-9, single spaces) and looked up among the known
licence sentences. The row of identifiers that a document then is gets compared with licence rules in their fixed order,
the more specific first; sentences that a rule has used are no longer there for later ones. One projection without shuffle or Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of published licences and of usual licence notices.
SENTENCES = {
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-head": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl-free": "This program is free software:",
    "gpl3-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl2-first": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl2-second": "either version 2 of the License, or (at your option) any later version.",
    "agpl3-later": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl3-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-details": "See the GNU General Public License for more details.",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "note-mit": "Released under the MIT License.",
    "note-mit-under": "Licensed under the MIT License.",
    "note-apache": "Licensed under the Apache License, Version 2.0.",
    "note-gpl3": "This work is licensed under the GNU General Public License, version 3.",
    "note-gpl2": "This work is licensed under the GNU General Public License, version 2.",
    "note-by-nc": "Licensed under CC BY-NC 4.0.",
    "note-by-sa": "Licensed under CC BY-SA 4.0.",
    "note-by": "Licensed under CC BY 4.0.",
    "note-cc0": "Licensed under CC0 1.0.",
    "note-bsd": "Released under the BSD License.",
    "note-rights": "All rights reserved.",
}

# Licence rules, tried in this order. Each is a row of sentences that stand one after the other.
RULES = [
    ("MIT", "mit-grant mit-notice mit-as-is mit-liability"),
    ("MIT", "mit-grant mit-notice mit-as-is"),
    ("MIT", "mit-grant mit-notice"),
    ("ISC", "isc-grant isc-as-is"),
    ("ISC", "isc-grant"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-names"),
    ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary"),
    ("Apache-2.0", "apache-head apache-comply apache-copy apache-as-is apache-see"),
    ("Apache-2.0", "apache-head apache-comply"),
    ("AGPL-3.0-or-later", "gpl-free agpl3-later"),
    ("LGPL-3.0-or-later", "gpl-free lgpl3-later"),
    ("GPL-3.0-or-later", "gpl-free gpl3-later gpl-hope gpl-implied gpl-details"),
    ("GPL-3.0-or-later", "gpl-free gpl3-later"),
    ("GPL-2.0-or-later", "gpl-free gpl2-first gpl2-second"),
    ("GPL-2.0-or-later", "gpl-free gpl2-later"),
    ("MPL-2.0", "mpl-subject mpl-copy"),
    ("Unlicense", "unlicense"),
    ("MIT", "note-mit"),
    ("MIT", "note-mit-under"),
    ("Apache-2.0", "note-apache"),
    ("GPL-3.0", "note-gpl3"),
    ("GPL-2.0", "note-gpl2"),
    ("CC-BY-NC-4.0", "note-by-nc"),
    ("CC-BY-SA-4.0", "note-by-sa"),
    ("CC-BY-4.0", "note-by"),
    ("CC0-1.0", "note-cc0"),
    ("BSD-unclear", "note-bsd"),
    ("all-rights-reserved", "note-rights"),
]

SENTENCE_END = r"[.;:!?]+([ \t\r\n]+|$)|\n[ \t\r]*\n"
LIST_MARK = r"^([0-9]{1,2}|[a-z]) "
BARE = r"^([0-9]{1,2}|[a-z])?$"  # nothing, or a list mark that the stop behind it has cut off


def plain(sentence: str) -> str:
    """A sentence as the lookup sees it."""
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


IDS = {name: i + 1 for i, name in enumerate(SENTENCES)}
LOOKUP = {plain(s): f"<{IDS[name]}>" for name, s in SENTENCES.items()}
UNKNOWN = "."
PATTERNS = [(licence, "".join(f"<{IDS[n]}>" for n in names.split())) for licence, names in RULES]


def _plain(text: Column) -> Column:
    """Line feeds stay: a sentence that nobody knows as a whole is looked up line by line."""
    return F.regexp_replace(F.lower(text), r"[^a-z0-9\n]+", " ")


def sentences(text: Column) -> Column:
    """The sentences of a text, not normalised; empty ones and mere list marks are left out."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), SENTENCE_END, "\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: ~F.regexp_replace(F.lower(s), "[^a-z0-9]+", "").rlike(BARE))


def identifiers(text: Column) -> Column:
    """One identifier per sentence, or per line of an unknown sentence; ``.`` where nothing is known."""
    known = F.create_map(*[F.lit(x) for pair in LOOKUP.items() for x in pair])

    def one(s: Column) -> Column:
        words = F.trim(F.regexp_replace(s, "[ \n]+", " "))
        return F.coalesce(known[words], known[F.regexp_replace(words, LIST_MARK, "")])

    def sentence(s: Column) -> Column:
        p = _plain(s)
        by_line = F.transform(F.split(p, "\n"), lambda line: F.coalesce(one(line), F.lit(UNKNOWN)))
        return F.when(one(p).isNotNull(), F.array(one(p))).when(p.contains("\n"), by_line).otherwise(F.array(F.lit(UNKNOWN)))

    return F.flatten(F.transform(sentences(text), sentence))


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_sentences, n_known (known licence sentences), matches (array of licence and how often its rule
    matched, in rule order), left_over (known sentences that no rule used).

    A NULL or empty text has no sentence and no match. NULL ids and repeated rows pass through, other columns are not read.
    """
    rules = F.array(*[F.struct(F.lit(licence).alias("licence"), F.lit(p).alias("pattern")) for licence, p in PATTERNS])
    start = F.struct(F.col("row").alias("row"), F.array().cast("array<struct<licence:string,times:int>>").alias("found"))

    def apply(state: Column, rule: Column) -> Column:
        rest = F.replace(state["row"], rule["pattern"], F.lit("#"))
        times = ((F.length(state["row"]) - F.length(rest)) / (F.length(rule["pattern"]) - 1)).cast("int")
        hit = F.array(F.struct(rule["licence"].alias("licence"), times.alias("times")))
        return F.when(F.instr(state["row"], rule["pattern"]) > 0, F.struct(rest.alias("row"), F.concat(state["found"], hit).alias("found"))).otherwise(state)

    own = docs.select("doc_id", F.size(sentences(F.col("text"))).cast("bigint").alias("n_sentences"), F.array_join(identifiers(F.col("text")), "").alias("row"))
    # A row without an identifier needs no rule.
    done = own.withColumn("state", F.when(F.col("row").contains("<"), F.aggregate(rules, start, apply)).otherwise(start))

    def known(row: Column) -> Column:
        return (F.length(row) - F.length(F.replace(row, F.lit("<"), F.lit("")))).cast("bigint")

    return done.select("doc_id", "n_sentences", known(F.col("row")).alias("n_known"), F.col("state.found").alias("matches"), known(F.col("state.row")).alias("left_over"))


def scan_sql() -> str:
    """The same as DuckDB SQL over ``documents``, with the matches as text."""
    known = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in LOOKUP.items()) + "}"

    def one(s: str) -> str:
        words = f"trim(regexp_replace({s}, '[ \\n]+', ' ', 'g'))"
        return f"coalesce(({known})[{words}], ({known})[regexp_replace({words}, '{LIST_MARK}', '')])"

    steps = ["s0 AS (SELECT doc_id, n_sentences, seq AS row0, seq, '' AS found0 FROM ids)"]
    for i, (licence, p) in enumerate(PATTERNS):
        times = f"CAST((length(row{i}) - length(replace(row{i}, '{p}', '#'))) / {len(p) - 1} AS INT)"
        steps.append(
            f"s{i + 1} AS (SELECT doc_id, n_sentences, seq, replace(row{i}, '{p}', '#') AS row{i + 1}, "
            f"found{i} || CASE WHEN contains(row{i}, '{p}') THEN '{licence}:' || {times} || ' ' ELSE '' END AS found{i + 1} FROM s{i})"
        )
    last = len(PATTERNS)
    return rf"""WITH cut AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(coalesce(text, ''), '{SENTENCE_END}', chr(1), 'g'), chr(1)),
    lambda s: NOT regexp_matches(regexp_replace(lower(s), '[^a-z0-9]+', '', 'g'), '{BARE}')) AS sentences FROM documents),
plain AS (SELECT doc_id, list_transform(sentences, lambda s: regexp_replace(lower(s), '[^a-z0-9\n]+', ' ', 'g')) AS sentences FROM cut),
ids AS (SELECT doc_id, CAST(len(sentences) AS BIGINT) AS n_sentences, coalesce(array_to_string(flatten(list_transform(sentences, lambda s:
    CASE WHEN {one("s")} IS NOT NULL THEN [{one("s")}]
    ELSE list_transform(string_split(s, chr(10)), lambda x: coalesce({one("x")}, '{UNKNOWN}')) END)), ''), '') AS seq FROM plain),
{", ".join(steps)}
SELECT doc_id, n_sentences, CAST(length(seq) - length(replace(seq, '<', '')) AS BIGINT) AS n_known, trim(found{last}) AS licenses,
  CAST(length(row{last}) - length(replace(row{last}, '<', '')) AS BIGINT) AS left_over FROM s{last}"""
