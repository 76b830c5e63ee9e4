"""Licence scans by sentence rules (DataFrame functions only).

Method
    A text is cut into pieces (at line ends and at sentence marks before a blank). A piece
    is normalised: lower case, every run of other characters than letters and digits one
    blank. A known licence sentence is found where its words run from the start of a piece
    to the end of the same or a later one, so wrapped lines and marks inside a sentence
    don't matter; a list number or letter before it is passed over. The longest known
    sentence at a place counts. Known sentences become identifiers; a piece of no known
    sentence is kept as a gap. A text is then a sequence of identifiers, and ordered rules,
    longer ones first, are matched against the sequence: a rule takes its run of identifiers
    out, so a later rule can't claim the same sentences again.

    MIT, BSD, ISC, 0BSD and the notices are known by all their sentences. The long licences
    (Apache, GPL, LGPL, AGPL, MPL, CC0) are known by their opening sentences (form
    "opening"), not by each of their sections.

    All of it happens within a row: no shuffle, no join, no Python. The table of known
    sentences is a literal map with a fixed number of entries. ``sql`` states the sentences
    that are one piece and their rules (``SENTENCES``, ``RULES``); it agrees where the other
    sentences don't occur.

Defined cases
    Null and empty texts have no sentences and no licences. Rows with equal doc_ids are
    rows of their own. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences (normalised) and their one-character identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "A",
    "licensed under the apache license version 2 0 the license": "A",
    "you may not use this file except in compliance with the license": "B",
    "you may obtain a copy of the license at": "C",
    "http www apache org licenses license 2 0": "D",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "E",
    "see the license for the specific language governing permissions and limitations under the license": "F",
    "released under the mit license": "G",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "H",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "I",
    "the software is provided as is without warranty of any kind express or implied": "J",
    "this work is licensed under the gnu general public license version 3": "K",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "L",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "M",
    "see the gnu general public license for more details": "N",
    "licensed under cc by nc 4 0": "O",
    "licensed under cc by 4 0": "P",
    "licensed under cc by sa 4 0": "Q",
    "this work is licensed under a creative commons attribution 4 0 international license": "R",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "S",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "T",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "U",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties are disclaimed": "V",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "W",
}

# The rules in order (licence, form, run of identifiers).
RULES = (
    ("Apache-2.0", "notice", "ABCDEF"),
    ("Apache-2.0", "notice", "ABCEF"),
    ("BSD-3-Clause", "text", "STUWV"),
    ("BSD-2-Clause", "text", "STUV"),
    ("MIT", "text", "HIJ"),
    ("GPL-3.0-or-later", "notice", "LMN"),
    ("GPL-3.0-or-later", "notice", "L"),
    ("Apache-2.0", "reference", "A"),
    ("MIT", "reference", "G"),
    ("GPL-3.0", "reference", "K"),
    ("CC-BY-NC-4.0", "reference", "O"),
    ("CC-BY-SA-4.0", "reference", "Q"),
    ("CC-BY-4.0", "reference", "P"),
    ("CC-BY-4.0", "reference", "R"),
)
#: A piece ends at a line end, or at marks before a blank or the end.
ENDS = r"[\r\n]+|[.!?;:]+(?:[\x20\t\r\n]+|$)"
GAP, TAKEN = " ", "#"

GNU = "* is free software you can redistribute it and or modify it under the terms of the gnu "
FSF = "as published by the free software foundation"
OPENING = " ** everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"
# Known sentences of official texts (normalised; * is up to 12 words that differ, ** up to 40) by name.
# One-character names are the identifiers of SENTENCES.
TEXTS = (
    ("A", "* licenses this file to you under the apache license version 2 0 the license"),
    ("D", "https www apache org licenses license 2 0"),
    ("apache-opening", "apache license version 2 0 january 2004 http www apache org licenses terms and conditions for use reproduction and distribution"),
    ("apache-opening", "apache license version 2 0 january 2004 https www apache org licenses terms and conditions for use reproduction and distribution"),
    ("H", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("I", "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"),
    ("J", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-liable", "in no event shall * be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("T", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-advert", "all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software developed by **"),
    ("W", "neither the name of * nor the names of * may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("W", "the name of * may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("W", "the names of * may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("V", "this software is provided by * as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd-liable", "in no event shall * be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-grant", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc-warranty", "the software is provided as is and * disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("isc-liable", "in no event shall * be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("L", f"{GNU}general public license {FSF} either version 3 of the license or at your option any later version"),
    ("gpl3-only", f"{GNU}general public license {FSF} version 3 of the license"),
    ("gpl3-only", f"{GNU}general public license version 3 {FSF}"),
    ("gpl2-later", f"{GNU}general public license {FSF} either version 2 of the license or at your option any later version"),
    ("gpl2-only", f"{GNU}general public license {FSF} version 2 of the license"),
    ("gpl2-only", f"{GNU}general public license version 2 {FSF}"),
    ("lgpl3-later", f"{GNU}lesser general public license {FSF} either version 3 of the license or at your option any later version"),
    ("lgpl21-later", f"{GNU}lesser general public license {FSF} either version 2 1 of the license or at your option any later version"),
    ("lgpl2-later", f"{GNU}library general public license {FSF} either version 2 of the license or at your option any later version"),
    ("agpl3-later", f"{GNU}affero general public license {FSF} either version 3 of the license or at your option any later version"),
    ("M", "* is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("N", "see the gnu lesser general public license for more details"),
    ("N", "see the gnu library general public license for more details"),
    ("N", "see the gnu affero general public license for more details"),
    ("gnu-copy", "you should have received a copy of the gnu general public license along with *"),
    ("gnu-copy", "you should have received a copy of the gnu lesser general public license along with *"),
    ("gnu-copy", "you should have received a copy of the gnu library general public license along with *"),
    ("gnu-copy", "you should have received a copy of the gnu affero general public license along with *"),
    ("gpl2-opening", f"gnu general public license version 2 june 1991{OPENING}"),
    ("gpl3-opening", f"gnu general public license version 3 29 june 2007{OPENING}"),
    ("lgpl21-opening", f"gnu lesser general public license version 2 1 february 1999{OPENING}"),
    ("lgpl3-opening", f"gnu lesser general public license version 3 29 june 2007{OPENING}"),
    ("lgpl2-opening", f"gnu library general public license version 2 june 1991{OPENING}"),
    ("agpl3-opening", f"gnu affero general public license version 3 19 november 2007{OPENING}"),
    ("mpl2-subject", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl2-copy", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("mpl2-copy", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    ("mpl2-opening", "mozilla public license version 2 0 1 definitions 1 1 contributor means each individual or legal entity that creates contributes to the creation of or owns covered software"),
    ("cc0-opening", "creative commons legal code cc0 1 0 universal creative commons corporation is not a law firm and does not provide legal services"),
    ("cc0", "licensed under cc0 1 0"),
    ("cc0", "to the extent possible under law * has waived all copyright and related or neighboring rights to **"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-nc-nd", "licensed under cc by nc nd 4 0"),
    ("Q", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("O", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-nc-sa", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
    ("cc-by-nc-nd", "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license"),
    ("R", "this work is licensed under the creative commons attribution 4 0 international license"),
    ("Q", "this work is licensed under the creative commons attribution sharealike 4 0 international license"),
    ("O", "this work is licensed under the creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nd", "this work is licensed under the creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-nc-sa", "this work is licensed under the creative commons attribution noncommercial sharealike 4 0 international license"),
    ("cc-by-nc-nd", "this work is licensed under the creative commons attribution noncommercial noderivatives 4 0 international license"),
)
GRANTS = (("GPL-3.0-only", "gpl3-only"), ("GPL-2.0-or-later", "gpl2-later"), ("GPL-2.0-only", "gpl2-only"), ("LGPL-3.0-or-later", "lgpl3-later"),
          ("LGPL-2.1-or-later", "lgpl21-later"), ("LGPL-2.0-or-later", "lgpl2-later"), ("AGPL-3.0-or-later", "agpl3-later"))
# The rules of official texts by names, before those of RULES, and the references after them.
TEXT_RULES = (
    ("BSD-4-Clause", "text", ("S", "T", "U", "bsd-advert", "W", "V", "bsd-liable")),
    ("BSD-3-Clause", "text", ("S", "T", "U", "W", "V", "bsd-liable")),
    ("BSD-2-Clause", "text", ("S", "T", "U", "V", "bsd-liable")),
    ("MIT", "text", ("H", "I", "J", "mit-liable")),
    ("ISC", "text", ("isc-grant", "isc-warranty", "isc-liable")),
    ("0BSD", "text", ("0bsd-grant", "isc-warranty", "isc-liable")),
    ("GPL-3.0-or-later", "notice", ("L", "M", "N", "gnu-copy")),
    *((a, "notice", (b, *rest)) for a, b in GRANTS for rest in (("M", "N", "gnu-copy"), ("M", "N"), ())),
    ("MPL-2.0", "notice", ("mpl2-subject", "mpl2-copy")),
    ("MPL-2.0", "notice", ("mpl2-subject",)),
    ("Apache-2.0", "opening", ("apache-opening",)),
    ("GPL-2.0", "opening", ("gpl2-opening",)),
    ("GPL-3.0", "opening", ("gpl3-opening",)),
    ("LGPL-2.0", "opening", ("lgpl2-opening",)),
    ("LGPL-2.1", "opening", ("lgpl21-opening",)),
    ("LGPL-3.0", "opening", ("lgpl3-opening",)),
    ("AGPL-3.0", "opening", ("agpl3-opening",)),
    ("MPL-2.0", "opening", ("mpl2-opening",)),
    ("CC0-1.0", "opening", ("cc0-opening",)),
)
TEXT_REFERENCES = (
    ("CC0-1.0", "reference", ("cc0",)),
    ("CC-BY-ND-4.0", "reference", ("cc-by-nd",)),
    ("CC-BY-NC-SA-4.0", "reference", ("cc-by-nc-sa",)),
    ("CC-BY-NC-ND-4.0", "reference", ("cc-by-nc-nd",)),
)
NAMES = tuple(dict.fromkeys(name for name, _ in TEXTS if len(name) > 1))


def identifier(name: str) -> str:
    return name if len(name) == 1 else chr(0xE000 + NAMES.index(name))


KNOWN = SENTENCES | {text: identifier(name) for name, text in TEXTS}
ALL_RULES = (*((a, b, "".join(map(identifier, run))) for a, b, run in TEXT_RULES), *RULES,
             *((a, b, "".join(map(identifier, run))) for a, b, run in TEXT_REFERENCES))
#: A list number or letter before a sentence.
LABEL = r"(?:(?:[0-9]{1,2}|[a-z]|[ivx]{2,4})[ \n])?"
#: An open place in a sentence takes up to 400 words, far more than any holder's name or notice; one before
#: the first fixed word, which is tried at every piece, up to 32.
WORDS = {"*": r"[a-z0-9]+(?:[ \n][a-z0-9]+){0,399}?", "**": r"[a-z0-9]+(?:[ \n][a-z0-9]+){0,399}?"}
OPENING = r"[a-z0-9]+(?:[ \n][a-z0-9]+){0,31}?"


def pattern(sentence: str) -> str:
    """The sentence's words over any cuts."""
    return r"[ \n]".join(WORDS.get(w, w) for w in sentence.split())


def alternatives(known: dict[str, str]) -> str:
    """All sentences, longer ones first, as the first alternative that fits is taken; those that start with open words share them."""
    ordered = sorted(known, key=lambda s: -len(s.split()))
    fixed = [pattern(s) for s in ordered if not s.startswith("* ")]
    opened = [pattern(s[2:]) for s in ordered if s.startswith("* ")]
    return "|".join(fixed + ([rf"{OPENING}[ \n](?:{'|'.join(opened)})"] if opened else []))


def sentences(text: Column) -> Column:
    """The normalised pieces, in order, without empty ones. Only A-Z is lower-cased and only a-z and 0-9 are kept."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = F.transform(F.split(lower, ENDS), lambda s: F.btrim(F.regexp_replace(s, r"[^a-z0-9]+", " ")))
    return F.filter(cut, lambda s: s != "")


def identifiers(found: Column, known: dict[str, str] = KNOWN) -> Column:
    """A string with a character per known sentence and per piece of none: its identifier, or a gap. Empty without known sentences."""
    pieces = F.concat(F.lit("\n"), F.array_join(found, "\n"), F.lit("\n"))
    any_ = alternatives(known)
    marked = F.regexp_replace(pieces, rf"\n{LABEL}({any_})(?=\n)", "\n#$1#")
    units = F.regexp_extract_all(marked, F.lit(r"\n(#[^#]*#|[^\n#]+)"), F.lit(1))
    exact = F.create_map(*[F.lit(x) for pair in known.items() if "*" not in pair[0] for x in pair])
    open_ = [(f"^{pattern(s)}$", i) for s, i in known.items() if "*" in s]

    def identified(unit: Column) -> Column:
        s = F.btrim(F.translate(unit, "\n", " "), F.lit("#"))
        return F.coalesce(F.try_element_at(exact, s), *[F.when(s.rlike(p), F.lit(i)) for p, i in open_], F.lit(GAP))

    sequence = F.array_join(F.transform(units, lambda u: F.when(u.startswith("#"), identified(u)).otherwise(F.lit(GAP))), "")
    # Most texts have none.
    return F.when(pieces.rlike(rf"\n{LABEL}(?:{any_})\n"), sequence).otherwise(F.lit(""))


def rule_matches(sequence: Column, rules: tuple = ALL_RULES) -> Column:
    """struct<left, counts>: how often each rule in order matches what the rules before it left, and what is left."""
    start = F.struct(sequence.alias("left"), F.array().cast("array<bigint>").alias("counts"))

    def step(state: Column, run: Column) -> Column:
        after = F.replace(state["left"], run, F.repeat(F.lit(TAKEN), F.length(run)))
        # A match changes each of its characters.
        n = (F.length(F.replace(state["left"], F.lit(TAKEN), F.lit(""))) - F.length(F.replace(after, F.lit(TAKEN), F.lit("")))) / F.length(run)
        return F.struct(after.alias("left"), F.concat(state["counts"], F.array(n.cast("long"))).alias("counts"))

    return F.aggregate(F.array(*[F.lit(run) for _, _, run in rules]), start, step)


def scan_licenses(docs: DataFrame, known: dict[str, str] = KNOWN, rules: tuple = ALL_RULES) -> DataFrame:
    """doc_id, n_sentences (pieces), n_known, licenses (array of license, form, matches in the rules' order), unmatched (known sentences no rule took)."""
    cut = docs.select("doc_id", sentences(F.col("text")).alias("found"))
    coded = cut.select("doc_id", F.size("found").cast("long").alias("n_sentences"), identifiers(F.col("found"), known).alias("sequence"))
    known_of = F.length(F.translate("sequence", GAP, "")).cast("long")
    # The rules run on what is known only; most texts have nothing.
    state = F.when(known_of > 0, rule_matches(F.col("sequence"), rules))
    ran = coded.select("doc_id", "n_sentences", known_of.alias("n_known"), state.alias("state"))
    matched: dict[tuple[str, str], list[Column]] = {}
    for i, (license_, form, _) in enumerate(rules):
        matched.setdefault((license_, form), []).append(F.col("state")["counts"][i])
    entries = [F.struct(F.lit(a).alias("license"), F.lit(b).alias("form"), reduce(Column.__add__, n).alias("matches"))
               for (a, b), n in matched.items()]
    none = F.array().cast("array<struct<license:string,form:string,matches:bigint>>")
    found = F.when(F.col("n_known") > 0, F.filter(F.array(*entries), lambda e: e["matches"] > 0)).otherwise(none)
    unmatched = F.length(F.regexp_replace(F.col("state")["left"], f"[{GAP}{TAKEN}]", "")).cast("long")
    return ran.select("doc_id", "n_sentences", "n_known", found.alias("licenses"), F.coalesce(unmatched, F.lit(0).cast("long")).alias("unmatched"))


def license_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_known, n_unmatched, n_licenses, licenses (license/form:matches, comma-joined)."""
    found = scan_licenses(docs)
    text = F.transform("licenses", lambda e: F.concat(e["license"], F.lit("/"), e["form"], F.lit(":"), e["matches"].cast("string")))
    return found.select("doc_id", "n_sentences", "n_known", F.col("unmatched").alias("n_unmatched"),
                        F.size("licenses").cast("long").alias("n_licenses"), F.array_join(text, ",").alias("licenses"))


def sql(known: dict[str, str] = SENTENCES, rules: tuple = RULES) -> str:
    """DuckDB: the same cuts and rules as list functions."""
    keys = ", ".join(f"'{s}'" for s in known)
    values = ", ".join(f"'{s}'" for s in known.values())
    steps, columns = [], []
    for i, (_, _, run) in enumerate(rules):
        before = f"l{i}" if i else "sequence"
        steps.append(f"s{i} AS (SELECT *, replace({before}, '{run}', '{TAKEN * len(run)}') AS l{i + 1} FROM {f's{i - 1}' if i else 'coded'})")
        columns.append(f"(length(replace({before}, '{TAKEN}', '')) - length(replace(l{i + 1}, '{TAKEN}', ''))) // {len(run)}")
    forms: dict[tuple[str, str], list[str]] = {}
    for (a, b, _), c in zip(rules, columns):
        forms.setdefault((a, b), []).append(c)
    entries = ", ".join(f"{{'k': '{a}/{b}', 'n': {' + '.join(c)}}}" for (a, b), c in forms.items())
    return rf"""
WITH cut AS (
  SELECT doc_id, list_filter(list_transform(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ENDS}'),
    lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') AS found FROM documents),
coded AS (
  SELECT doc_id, len(found) AS n, array_to_string(list_transform(found, lambda s: coalesce(([{values}])[list_position([{keys}], s)], ' ')), '') AS sequence FROM cut),
{", ".join(steps)},
hit AS (SELECT *, list_filter([{entries}], lambda e: e.n > 0) AS e FROM s{len(rules) - 1})
SELECT doc_id, n::BIGINT AS n_sentences, length(replace(sequence, ' ', ''))::BIGINT AS n_known,
  length(replace(replace(l{len(rules)}, ' ', ''), '{TAKEN}', ''))::BIGINT AS n_unmatched,
  len(e)::BIGINT AS n_licenses, coalesce(array_to_string(list_transform(e, lambda x: x.k || ':' || x.n::BIGINT), ','), '') AS licenses
FROM hit
"""
