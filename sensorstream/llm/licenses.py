"""Licence scans: texts compared with licence templates by Dice coefficient.

A document is compared whole, by paragraph, by line and by sentence. Each such unit is normalised
(lower case, runs of anything but letters and digits become one space) and turned into its set
of word bigrams. Two sets of sizes a and b share at most the smaller, so Dice
reaches t only if  a t / (2 - t) <= b <= a (2 - t) / t: other templates are not
compared. So many of a template's bigrams must be in the unit that some of any a - a t / (2 - t) + 1
are: a text without one of these from any template is not divided into units at all.
Templates whose words follow one another anywhere in the text, whatever stands around them, are found as well.

Only DataFrame functions are used, row by row, without a shuffle.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstream.llm.common import fresh_name, text_of

THRESHOLD = 0.8

# The notices of common licences, by SPDX identifier. Longer licences are held by
# paragraph, as the units of a document are. The whole texts of all but the CC BY licences are beside this
# file. A paragraph of several licences counts for the first of them in SQL, for each of them here.
NOTICES = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0.

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "BSD-3-Clause": """3. Neither the name of the copyright holder nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written permission.""",
    "CC-BY-4.0": """Licensed under CC BY 4.0.

This work is licensed under a Creative Commons Attribution 4.0 International License.""",
    "CC-BY-NC-4.0": """Licensed under CC BY-NC 4.0.

This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.""",
    "CC-BY-SA-4.0": """Licensed under CC BY-SA 4.0.

This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.""",
    "CC0-1.0": """To the extent possible under law, the author has waived all copyright and related or
neighboring rights to this work.""",
    "GPL-3.0": """This work is licensed under the GNU General Public License, version 3.

This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version.

You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.""",
    "GPL-2.0": """This work is licensed under the GNU General Public License, version 2.

GNU General Public License, version 2, June 1991.

This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
option) any later version.

This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
Public License version 2 as published by the Free Software Foundation.

You should have received a copy of the GNU General Public License along with this program; if not, see
<https://www.gnu.org/licenses/>.""",
    "AGPL-3.0": """This work is licensed under the GNU Affero General Public License, version 3.

This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
your option) any later version.

You should have received a copy of the GNU Affero General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.""",
    "LGPL-2.0": """This work is licensed under the GNU Library General Public License, version 2.""",
    "LGPL-2.1": """This work is licensed under the GNU Lesser General Public License, version 2.1.""",
    "LGPL-3.0": """This work is licensed under the GNU Lesser General Public License, version 3.

This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
your option) any later version.

You should have received a copy of the GNU Lesser General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies.""",
    "MIT": """Released under the MIT License.

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.""",
}


#: Paragraphs of whole texts with fewer bigrams are headings that name no licence.
LEAST_BIGRAMS = 8


@dataclass(frozen=True)
class Template:
    license: str
    bigrams: tuple[str, ...]
    phrase: str = ""
    holders: tuple[str, ...] = ()

    def bounds(self, threshold: float) -> tuple[int, int]:
        """Numbers of bigrams with which a unit can reach the threshold."""
        size, ratio = len(self.bigrams), (2 - threshold) / threshold
        return math.ceil(size / ratio - 1e-9), math.floor(size * ratio + 1e-9)


    def telling(self, threshold: float) -> list[str]:
        """Bigrams of which a unit at the threshold holds one at least: the longest, as they are rare."""
        size = len(self.bigrams)
        spared = size - math.ceil(size * threshold / (2 - threshold) - 1e-9)
        return sorted(self.bigrams, key=lambda b: (-len(b), b))[: spared + 1]


def words_of(text: str) -> list[str]:
    """The words of normalised text."""
    return re.sub(r"[^\w]+|_", " ", text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    """Distinct word bigrams of normalised text, in order."""
    words = words_of(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def whole_texts() -> dict[str, str]:
    """The whole texts of licences, by identifier, from wherever the package was imported.

    Of all licences that are held but the CC BY ones a text must be there.
    """
    folder = files(__package__).joinpath("texts")
    names = sorted(f.name for f in folder.iterdir()) if folder.is_dir() else []
    texts = {n.removesuffix(".txt"): folder.joinpath(n).read_text("utf-8") for n in names if n.endswith(".txt")}
    missing = sorted(k for k in NOTICES if k not in texts and not k.startswith("CC-BY"))
    if missing:
        raise FileNotFoundError(f"the package was shipped without its licence texts: {', '.join(missing)}")
    return texts


def templates_of(notices: dict[str, str] = NOTICES) -> list[Template]:
    """One template per paragraph, and one for the whole notice or text where it has several.

    One that is in the texts of several licences goes by the first of them.
    """
    found: dict[tuple[str, ...], tuple[str, dict[str, None]]] = {}
    texts = whole_texts() if notices is NOTICES else {}
    for license, text in notices.items():
        whole = texts.get(license, "")
        paragraphs = [p for p in re.split(r"\n\s*\n", whole) if len(bigrams_of(p)) >= LEAST_BIGRAMS]
        for unit in [*text.split("\n\n"), text, *paragraphs, whole]:
            _, holders = found.setdefault(tuple(bigrams_of(unit)), (" ".join(words_of(unit)), {}))
            holders[license] = None
    full = {k: [f" {' '.join(words_of(t))} " for t in (text, texts.get(k, ""))] for k, text in notices.items()}
    for phrase, holders in found.values():
        holders |= dict.fromkeys(k for k, known in full.items() if any(f" {phrase} " in t for t in known))
    return [Template(next(iter(h)), bigrams, phrase, tuple(h)) for bigrams, (phrase, h) in found.items() if bigrams]


def units_of(text: Column) -> Column:
    """The distinct lines, paragraphs and whole of a text."""
    lines, paragraphs = F.split(text, "\n"), F.split(text, r"\n\s*\n")
    return F.array_distinct(F.concat(lines, paragraphs, F.array(text)))


def parts_of(text: Column) -> Column:
    """Paragraphs between lines without letters or digits, such as comment marks, and their sentences."""
    paragraphs = F.split(text, r"\n(?:[^\p{L}\p{N}\n]*\n)+")
    sentences = F.flatten(F.transform(paragraphs, lambda p: F.split(p, r"(?<=[.!?])\s+")))
    return F.array_distinct(F.concat(paragraphs, sentences))


def best_license(
    docs: DataFrame,
    *,
    notices: dict[str, str] = NOTICES,
    threshold: float = THRESHOLD,
    text: str = "text",
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with new columns, whose names are the second value.

    ``license`` is the best match: of the units at ``threshold`` or more, and of the templates found word by word; null
    without one. ``dice`` is its coefficient, 0 without a match; below the threshold for a template whose words stand
    in no unit close enough to it, such as a sentence that says more, or denies it. Of equals, a licence whose best matches are all another's as well gives way to it if that
    one has more matched bigrams in all; then the first by name counts. ``matches`` is the number of pairs of a
    distinct unit (line, paragraph or whole) and a template at the threshold, and of sentences, paragraphs between
    comment marks and templates found word by word for licences that no such unit names. Null text counts as
    empty: no match. Rows are looked at one by one, repeated or not, however long. An empty table gives an empty one.
    """
    templates = templates_of(notices)
    names = {k: fresh_name(k) for k in ("license", "dice", "matches")}
    limits = [t.bounds(threshold) for t in templates]
    telling = sorted({b for t in templates for b in t.telling(threshold)})
    whole, words, told, units, parts, hits, more = (
        fresh_name(k) for k in ("whole", "words", "told", "units", "parts", "hits", "more")
    )
    # One literal each, as thousands of them take the planner long.
    rows = [
        {
            "holders": t.holders,
            "low": low,
            "high": high,
            "first": t.telling(threshold)[0],
            "phrase": f" {t.phrase} ",
            "bigrams": t.bigrams,
        }
        for t, (low, high) in zip(templates, limits)
    ]
    table = F.from_json(
        F.lit(json.dumps(rows)),
        "array<struct<holders:array<string>,low:int,high:int,first:string,phrase:string,bigrams:array<string>>>",
    )

    def normal(unit: Column) -> Column:
        return F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "))

    def pairs(w: Column) -> Column:
        return F.zip_with(
            F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b)
        )

    def sets(found: Column) -> Column:
        split = F.filter(F.transform(F.array_distinct(F.transform(found, normal)), lambda u: F.split(u, " ")), lambda w: F.size(w) > 1)
        return F.filter(F.transform(split, lambda w: F.array_distinct(pairs(w))), lambda u: F.arrays_overlap(u, F.col(told)))

    def hit(dice: Column, common: Column, t: Column) -> Column:
        return F.struct(dice.alias("dice"), common.alias("common"), t["holders"].alias("holders"))

    def compared(unit: Column) -> Column:
        fitting = F.filter(table, lambda t: F.size(unit).between(t["low"], t["high"]))
        counted = F.transform(
            fitting, lambda t: F.struct(F.size(F.array_intersect(unit, t["bigrams"])).alias("common"), t.alias("t"))
        )
        return F.transform(
            counted,
            lambda c: hit(
                F.lit(2.0) * c["common"] / (F.size(unit) + F.size(c["t"]["bigrams"])), c["common"], c["t"]
            ),
        )

    def matched(found: str) -> Column:
        return F.filter(F.flatten(F.transform(F.col(found), compared)), lambda m: m["dice"] >= threshold)

    said = F.concat(F.lit(" "), F.col(whole), F.lit(" "))

    def closest(t: Column) -> Column:
        """The coefficient of the unit that is closest to a template; the whole text is a unit too."""
        common = lambda u: F.size(F.array_intersect(u, t["bigrams"]))
        dice = lambda u: F.lit(2.0) * common(u) / (F.size(u) + F.size(t["bigrams"]))
        return F.array_max(F.transform(F.concat(F.col(units), F.col(parts)), dice))

    phrases = F.transform(
        F.filter(table, lambda t: F.array_contains(F.col(told), t["first"]) & F.contains(said, t["phrase"])),
        lambda t: hit(closest(t), F.size(t["bigrams"]), t),
    )
    none = F.array().cast("array<array<string>>")
    no_hit = F.array().cast("array<struct<dice:double,common:int,holders:array<string>>>")
    scanned = (
        docs.withColumn(whole, normal(text_of(text)))
        .withColumn(words, F.split(F.col(whole), " "))
        .withColumn(told, F.array_distinct(F.filter(pairs(F.col(words)), lambda b: b.isin(telling))))
        .withColumn(units, F.when(F.size(told) > 0, sets(units_of(text_of(text)))).otherwise(none))
        .withColumn(parts, F.when(F.size(told) > 0, F.array_except(sets(parts_of(text_of(text))), F.col(units))).otherwise(none))
        .withColumn(hits, matched(units))
        .withColumn(more, F.when(F.size(told) > 0, F.concat(matched(parts), phrases)).otherwise(no_hit))
    )
    every = F.concat(F.col(hits), F.col(more))
    top = F.array_max(F.transform(every, lambda m: m["dice"]))
    firsts = F.filter(every, lambda m: m["dice"] == top)

    def gives_way(a: Column) -> Column:
        mine = F.filter(firsts, lambda m: F.array_contains(m["holders"], a))
        return F.exists(
            candidates,
            lambda b: F.forall(mine, lambda m: F.array_contains(m["holders"], b)) & (weight(b) > weight(a)),
        )

    def weight(a: Column) -> Column:
        """Matched bigrams of a licence."""
        held = F.filter(every, lambda m: F.array_contains(m["holders"], a))
        return F.aggregate(held, F.lit(0), lambda n, m: n + m["common"])

    candidates = F.array_distinct(F.flatten(F.transform(firsts, lambda m: m["holders"])))
    license = F.array_min(F.filter(candidates, lambda a: ~gives_way(a)))
    named = F.array_distinct(F.flatten(F.transform(F.col(hits), lambda m: m["holders"])))
    unnamed = F.filter(F.col(more), lambda m: ~F.arrays_overlap(m["holders"], named))
    out = [
        *(F.col(f"`{c}`") for c in docs.columns),
        F.when(F.size(every) > 0, license).alias(names["license"]),
        F.coalesce(top, F.lit(0.0)).alias(names["dice"]),
        (F.size(hits) + F.size(unnamed)).alias(names["matches"]),
    ]
    return scanned.select(*out), names


def oracle_sql(notices: dict[str, str] = NOTICES, threshold: float = THRESHOLD) -> str:
    """The columns of ``best_license`` for ``documents`` in DuckDB's SQL, comparing every template."""
    rows = ",\n".join(
        "({}, '{}', [{}])".format(k, t.license, ", ".join(f"'{b}'" for b in t.bigrams))
        for k, t in enumerate(templates_of(notices))
    )
    return f"""
WITH templates(template, license, bigrams) AS (VALUES {rows}),
units AS (
  SELECT DISTINCT place, trim(regexp_replace(lower(unit), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS unit
  FROM (SELECT place, unnest(list_concat(string_split(t, chr(10)),
                                      regexp_split_to_array(t, '\\n\\s*\\n'), [t])) AS unit
        FROM (SELECT doc_id AS place, coalesce(text, '') AS t FROM documents))
), sets AS (
  SELECT place, unit, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS bigrams
  FROM (SELECT place, unit, string_split(unit, ' ') AS w FROM units)
), hits AS (
  SELECT place, t.license,
    2.0::double * len(list_intersect(s.bigrams, t.bigrams)) / (len(s.bigrams) + len(t.bigrams)) AS dice
  FROM sets s, templates t
  WHERE len(s.bigrams) <= 4 * len(t.bigrams) AND len(t.bigrams) <= 4 * len(s.bigrams)
), best AS (
  SELECT place, arg_min(license, {{'less': -dice, 'license': license}}) AS license, max(dice) AS dice, count(*) AS matches
  FROM hits WHERE dice >= {threshold} GROUP BY place
)
SELECT doc_id, best.license, coalesce(best.dice, 0) AS dice, coalesce(best.matches, 0)::integer AS matches
FROM documents LEFT JOIN best ON doc_id = place"""
