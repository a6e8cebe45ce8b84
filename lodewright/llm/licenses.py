"""Licence notices in texts: parts of a text compared to templates by the Dice coefficient of word bigrams.

A part is a sentence, a line, the text as a whole, or a window of consecutive words anywhere in it, across lines and
sentences. Texts and templates are normalised alike: ASCII letters in lower case, all but letters and digits as one
blank. Two sets of n and m bigrams can reach the least coefficient d only if n is between d/(2-d) and (2-d)/d times
m, so the templates of other sizes are passed over. A part that reaches d has d/(2-d) of a template's bigrams at
least, so texts that hold none of the others and one more are passed over before they are cut into parts, and
windows are made for templates only of which the text has so many bigrams. The best window begins and ends with a
bigram of the template, as others could be shortened; it has up to (2-d)/d times m bigrams. All of it is Spark
expressions on the row.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, floor
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewright.llm.fingerprints import let
from lodewright.llm.tables import lower_ascii

LEAST = 0.8

# Notices as their licences word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
    "file except in compliance with the License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms "
    "of the GNU General Public License as published by the Free Software Foundation, either version 3 of the "
    "License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    'and associated documentation files (the "Software"), to deal in the Software without restriction',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

# What ends a part, apart from the ends of lines: a mark with white space after it.
_SENTENCE = r"[\n\r]+|(?<=[.!?;])[ \t]+"
_LINE = r"[\n\r]+"
_OTHER = r"[^\p{L}\p{N}]+"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(lower_ascii(text), _OTHER, " "))


def bigrams(text: Column) -> Column:
    """Distinct pairs of neighbouring words of a normalised text."""
    words = F.split(text, " ")
    return let(
        words,
        lambda w: F.when(F.size(w) < 2, F.array().cast("array<string>")).otherwise(
            F.array_distinct(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))),
                    lambda i: F.concat_ws(" ", F.slice(w, i, 2)),
                )
            )
        ),
    )


def _template_bigrams(text: str) -> list[str]:
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _windows(flat: Column, known: dict[str, list[str]], least: float) -> Column:
    """(dice, licence) of the best window of consecutive words of a normalised text, by template; null or none where
    the text has too few of its bigrams."""
    templates = F.array(
        *(
            F.struct(
                F.lit(name).alias("licence"),
                F.array(*map(F.lit, pairs)).alias("own"),
                F.lit(ceil(len(pairs) * least / (2 - least) - 1e-9)).alias("need"),
                F.lit(floor(len(pairs) * (2 - least) / least + 1e-9)).alias("most"),
            )
            for name, pairs in sorted(known.items())
        )
    )
    near = F.filter(
        templates, lambda t: F.size(F.filter(t["own"], lambda pair: F.contains(flat, pair))) >= t["need"]
    )

    def ordered(words: Column) -> Column:
        """The pairs of neighbouring words, with repeats."""
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))),
            lambda i: F.concat_ws(" ", F.slice(words, i, 2)),
        )

    def dice(window: Column, own: Column) -> Column:
        return 2.0 * F.size(F.array_intersect(window, own)) / (F.size(F.array_distinct(window)) + F.size(own))

    def from_hit(pairs: Column, hits: Column, k: Column, t: Column) -> Column:
        """Of the windows that begin at the k-th hit and end at another one."""
        first = F.element_at(hits, k)
        ends = F.filter(F.slice(hits, k, t["most"]), lambda e: e < first + t["most"])
        return let(
            ends,
            lambda ends: F.when(
                F.size(ends) >= t["need"],
                F.transform(
                    F.slice(ends, t["need"], F.size(ends)),
                    lambda e: dice(F.slice(pairs, first, e - first + 1), t["own"]),
                ),
            ).otherwise(F.array().cast("array<double>")),
        )

    def best(pairs: Column, t: Column) -> Column:
        hits = F.filter(
            F.sequence(F.lit(1), F.size(pairs)), lambda i: F.array_contains(t["own"], F.element_at(pairs, i))
        )
        return let(
            hits,
            lambda hits: F.when(
                F.size(hits) >= t["need"],
                F.array_max(
                    F.flatten(
                        F.transform(
                            F.sequence(F.lit(1), F.size(hits)), lambda k: from_hit(pairs, hits, k, t)
                        )
                    )
                ),
            ),
        )

    none = F.array().cast("array<struct<dice:double,licence:string>>")
    return let(
        near,
        lambda near: F.when(F.size(near) == 0, none).otherwise(
            let(
                let(F.split(flat, " "), ordered),
                lambda pairs: F.transform(
                    near, lambda t: F.struct(best(pairs, t).alias("dice"), t["licence"].alias("licence"))
                ),
            )
        ),
    )


def scan(
    frame: DataFrame,
    templates: dict[str, str] | None = None,
    least: float = LEAST,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """A row per text: key, licence, dice, n_licences, licences.

    ``licences`` lists (dice, licence) of every template that some part reaches ``least`` with, best first, ties
    by name; ``licence`` and ``dice`` are the first of them, null if there is none. A null or empty text has none.
    ``templates`` is a mapping of names to texts of two words or more, of a size that fits a plan. Repeated rows
    give repeated results; other columns are not looked at.
    """
    known = {name: _template_bigrams(t) for name, t in (templates or TEMPLATES).items()}
    sizes = {name: len(pairs) for name, pairs in known.items()}
    low = min(sizes.values()) * least / (2 - least)
    high = max(sizes.values()) * (2 - least) / least
    rows = frame.select(
        frame[key].alias("doc_id"), F.coalesce(frame[text], F.lit("")).alias("text")
    )
    whole = F.col("text")
    parts = F.array_distinct(
        F.transform(
            F.concat(F.split(whole, _SENTENCE), F.split(whole, _LINE), F.array(whole)), normalised
        )
    )
    # By the number of words, which is above that of distinct bigrams: parts below the least size have too few.
    # Of these bigrams each part that matters has one at least.
    telling = sorted(
        {
            pair
            for pairs in known.values()
            for pair in sorted(pairs, key=lambda x: (-len(x), x))[: len(pairs) - ceil(len(pairs) * least / (2 - least) - 1e-9) + 1]
        }
    )
    rows = rows.withColumn("flat", normalised(whole))
    telltale = reduce(or_, (F.contains("flat", F.lit(pair)) for pair in telling))
    none = F.array().cast("array<string>")
    across = F.array().cast("array<struct<dice:double,licence:string>>")
    rows = rows.withColumn("windows", F.when(telltale, _windows(F.col("flat"), known, least)).otherwise(across))
    pieces = rows.withColumn("parts", F.when(telltale, parts).otherwise(none)).withColumn(
        "parts",
        F.filter(
            F.col("parts"),
            lambda p: F.length(p) - F.length(F.replace(p, F.lit(" "))) >= F.lit(int(-(-low // 1))),
        ),
    )
    sets = pieces.withColumn(
        "parts", F.filter(F.transform("parts", bigrams), lambda b: F.size(b).between(low, high))
    )

    def best(name: str) -> Column:
        own = F.array(*(F.lit(pair) for pair in known[name]))
        near = F.filter(
            F.col("parts"),
            lambda b: F.size(b).between(
                sizes[name] * least / (2 - least), sizes[name] * (2 - least) / least
            ),
        )
        dice = F.transform(
            near, lambda b: 2.0 * F.size(F.array_intersect(b, own)) / (F.size(b) + sizes[name])
        )
        across = F.transform(F.filter("windows", lambda x: x["licence"] == name), lambda x: x["dice"])
        return F.struct(F.array_max(F.concat(dice, across)).alias("dice"), F.lit(name).alias("licence"))

    found = F.array_sort(
        F.filter(F.array(*(best(name) for name in sorted(known))), lambda x: x["dice"] >= least),
        lambda a, b: F.when(a["dice"] > b["dice"], -1)
        .when(a["dice"] < b["dice"], 1)
        .when(a["licence"] < b["licence"], -1)
        .otherwise(1),
    )
    result = sets.select("doc_id", found.alias("licences"))
    first = F.try_element_at("licences", F.lit(1))
    return result.select(
        "doc_id",
        first["licence"].alias("licence"),
        first["dice"].alias("dice"),
        F.size("licences").cast("long").alias("n_licences"),
        "licences",
    )


def _values() -> str:
    return ", ".join(
        "('{}', [{}])".format(name, ", ".join("'" + pair + "'" for pair in _template_bigrams(t)))
        for name, t in sorted(TEMPLATES.items())
    )


ORACLE = rf"""
WITH templates(licence, own) AS (VALUES {_values()}),
parts AS (
  SELECT DISTINCT n, unnest(list_transform(
      list_concat(list_concat(
        string_split_regex(regexp_replace(text, '([.!?;])[ \t]+', '\1' || chr(10), 'g'), '[\n\r]+'),
        string_split_regex(text, '[\n\r]+')), [text]),
      lambda p: trim(regexp_replace(
        translate(p, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')
      ))) AS part
  FROM (SELECT row_number() OVER () AS n, coalesce(text, '') AS text FROM documents)
),
pairs AS (
  SELECT DISTINCT n, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b
  FROM (SELECT n, string_split(part, ' ') AS w FROM parts) WHERE len(w) > 1
),
near AS (
  SELECT n, licence, max(2.0::DOUBLE * len(list_intersect(b, own)) / (len(b) + len(own))) AS dice
  FROM pairs JOIN templates ON len(b) BETWEEN len(own) * {LEAST / (2 - LEAST)!r} AND len(own) * {(2 - LEAST) / LEAST!r}
  GROUP BY ALL
),
best AS (
  SELECT n, count(*) AS n_licences, first(licence ORDER BY dice DESC, licence) AS licence, max(dice) AS dice
  FROM near WHERE dice >= {LEAST} GROUP BY n
)
SELECT doc_id, licence, dice, coalesce(n_licences, 0) AS n_licences
FROM (SELECT row_number() OVER () AS n, doc_id FROM documents) LEFT JOIN best USING (n)
"""
