"""Licences of files: sparse TF-IDF cosine of their notices to templates, then inheritance by directory.

A notice is a sentence that holds a word of licensing, read within a line and across the lines of a
paragraph, without comment marks. Its words, weighted by how rare they are among the
templates, are held against each template; the best cosine of at least ``MIN_COSINE`` names the
licence, a GNU licence only beside its version. Any text with a word of licensing is also held whole against whole
licences (folder ``licence_texts``) with the same cosine, of at least ``WHOLE_COSINE``. A file that is such a
text, or that has a notice and the name of a licence file (``FILE_NAME``), speaks for its directory; any other
notice speaks for its own file alone. A file without a notice of its own inherits from the nearest ancestor
directory, found by joining the list of a directory's ancestors with the directories that have one. Where the
files that speak for a directory name different licences, it gives none: what would inherit there is ``disputed``.

Notices are read from whole texts, in expressions over one row. Directories are distinct before they
are expanded, a directory with a large share of the files is answered by broadcast.

Defined cases. Null and empty texts have no notice but inherit. A null path is in no
directory. A whole licence counts before notices and a reservation of all rights after other notices. Of several
the one with the highest cosine counts, then the first by name. The CC BY licences have no whole text here.
Repeated rows stay, extra columns are ignored; a kept column with the name of a result is given as ``kept_<name>``.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.llm.common import hidden, join_split, materialise

MIN_COSINE = 0.55
WHOLE_COSINE = 0.7
FILE_NAME = r"(?i)^(?:licen[sc]es?|copying|copyright|notice)(?:[._-][^/]*)?$"

# Notices of widely used licences, by SPDX name.
_GNU = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {what}General Public "
    "License as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version"
)
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0 Universal",),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        _GNU.format(what="", version="2"),
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        _GNU.format(what="", version="3"),
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1",
        _GNU.format(what="Lesser ", version="2.1"),
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3",
        _GNU.format(what="Lesser ", version="3"),
    ),
    "MIT": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "proprietary": (
        "All rights reserved. No part of this work may be copied without permission",
        "All rights reserved",
        "Copyright (c) all rights reserved",
    ),
}
SPDX = "SPDX-License-Identifier: "
for _name in TEMPLATES:
    if _name != "proprietary":
        TEMPLATES[_name] += (SPDX + _name,)
        if "GPL" in _name:
            TEMPLATES[_name] += (SPDX + _name + "-only", SPDX + _name + "-or-later")
TEMPLATES["BSD-2-Clause"] = ("Released under the BSD 2-Clause License", SPDX + "BSD-2-Clause")
NOTICE = r"(?i)licen[sc]e|creative commons|\bCC[ -]?(?:BY|0)|copyright|all rights reserved|public domain|hereby granted|redistribution"
SENTENCE = r"\n|(?<=[.!?;])[ \t]+(?=[A-Z])"
# A line's end within a paragraph, with the comment mark of the next line.
WRAP = r"[ \t\r]*\n[ \t]*(?:(?:[#*;%]+|//+|--+)(?=[ \t]))?[ \t]*(?=[^\x20\x09-\x0D])"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def _terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def template_weights(templates: dict[str, tuple[str, ...]] = TEMPLATES) -> tuple[list[tuple[str, dict[str, float]]], dict[str, float], float]:
    """Unit vectors of the templates, the weight of each of their words, and that of any other word."""
    texts = [(name, Counter(_terms(t))) for name, parts in sorted(templates.items()) for t in parts]
    seen = Counter(term for _, counts in texts for term in counts)
    idf = {t: math.log((1 + len(texts)) / (1 + n)) + 1 for t, n in seen.items()}
    vectors = []
    for name, counts in texts:
        raw = {t: (1 + math.log(n)) * idf[t] for t, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        vectors.append((name, {t: x / norm for t, x in raw.items()}))
    return vectors, idf, math.log(1 + len(texts)) + 1


@cache
def whole_texts() -> dict[str, tuple[str, ...]]:
    """Whole licences by SPDX name; read on the driver only."""
    return {p.stem: (p.read_text(),) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}


def _versioned(text: Column, licence: Column) -> Column:
    """False for a GNU licence whose version the text does not hold."""
    version = F.regexp_extract(licence, r"GPL-([0-9.]+?)(?:\.0)?$", 1)
    pattern = F.concat(F.lit(r"(?<![0-9.])"), F.replace(version, F.lit("."), F.lit("\\.")), F.lit(r"(?:\.0)?(?!\.?[0-9])"))
    return (version == "") | F.regexp_like(text, pattern)


def _with_scores(df: DataFrame, texts: str, name: str, templates: dict[str, tuple[str, ...]]) -> DataFrame:
    """Add an array of (text, score, licence), the best template of each text of an array.

    Each step reads the one before, so that nothing is worked out twice. Terms are sorted and counted by
    their runs. The templates are a map, by first character, of maps from a word to its weight and its place in
    every template's vector.
    """
    vectors, idf, other = template_weights(templates)
    known: dict[str, dict] = {}
    for t, x in sorted(idf.items()):
        known.setdefault(t[0], {})[t] = {"i": x, "v": [v.get(t, 0.0) for _, v in vectors]}
    table = F.from_json(F.lit(json.dumps(known)), "map<string,map<string,struct<i:double,v:array<double>>>>")
    names = F.array(*[F.lit(n) for n, _ in vectors])
    zeros = F.array_repeat(F.lit(0.0), len(vectors))
    steps = [hidden(f"step{i}") for i in range(6)]
    sorted_, begun, counted, weighed, scored, best = (F.col(x) for x in steps)
    found = lambda x: F.regexp_extract_all(F.lower(x), F.lit(f"({TERM})"), F.lit(1))
    places = lambda s: F.when(F.size(s) > 0, F.sequence(F.lit(0), F.size(s) - 1)).otherwise(F.array().cast("array<int>"))
    begins = lambda s: F.filter(places(s), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
    out = df.withColumn(steps[0], F.transform(F.col(texts), lambda x: F.struct(x.alias("text"), F.array_sort(found(x)).alias("s"))))
    out = out.withColumn(steps[1], F.transform(sorted_, lambda r: F.struct(r["text"].alias("text"), r["s"].alias("s"), begins(r["s"]).alias("b"))))
    run = lambda r, p, j: (F.coalesce(F.get(r["b"], j + 1), F.size(r["s"])) - p).cast("double")
    look = lambda t: F.try_element_at(F.try_element_at(table, F.substring(t, 1, 1)), t)
    out = out.withColumn(
        steps[2],
        F.transform(
            begun,
            lambda r: F.struct(
                r["text"].alias("text"),
                F.transform(
                    r["b"], lambda p, j: F.struct((1 + F.log(run(r, p, j))).alias("n"), look(F.get(r["s"], p)).alias("k"))
                ).alias("terms"),
            ),
        ),
    )
    weigh = lambda t: F.struct((t["n"] * F.coalesce(t["k"]["i"], F.lit(other))).alias("x"), t["k"]["v"].alias("v"))
    out = out.withColumn(
        steps[3], F.transform(counted, lambda r: F.struct(r["text"].alias("text"), F.transform(r["terms"], weigh).alias("terms")))
    )
    out = out.withColumn(
        steps[4],
        F.transform(
            weighed,
            lambda r: F.struct(
                r["text"].alias("text"),
                F.sqrt(F.aggregate(r["terms"], F.lit(0.0), lambda s, t: s + t["x"] * t["x"])).alias("norm"),
                F.aggregate(
                    F.filter(r["terms"], lambda t: t["v"].isNotNull()),
                    zeros,
                    lambda s, t: F.zip_with(s, t["v"], lambda a, b: a + t["x"] * b),
                ).alias("dots"),
            ),
        ),
    )
    top = lambda r: F.array_max(F.transform(r["dots"], lambda d, i: F.struct((d / r["norm"]).alias("score"), (-i).alias("i"))))
    out = out.withColumn(steps[5], F.transform(scored, lambda r: F.struct(r["text"].alias("text"), top(r).alias("m"))))
    last = lambda r: F.struct(
        r["text"].alias("text"), r["m"]["score"].alias("score"), F.get(names, -r["m"]["i"]).alias("licence")
    )
    return out.withColumn(name, F.transform(best, last)).drop(*steps)


def _with_licences(df: DataFrame, text: str) -> DataFrame:
    """Add ``notices`` and ``whole``: arrays of (text, score, licence) that reach their limits."""
    parts, all_, one = hidden("parts"), hidden("all"), hidden("one")
    some = F.regexp_like(F.col(text), F.lit(NOTICE))
    cut = lambda x: F.filter(F.split(x, SENTENCE, -1), lambda p: F.regexp_like(p, F.lit(NOTICE)))
    joined = F.regexp_replace(F.col(text), F.lit(WRAP), F.lit(" "))
    out = df.withColumn(parts, F.when(some, F.array_distinct(F.concat(cut(F.col(text)), cut(joined)))))
    out = _with_scores(out.withColumn(one, F.when(some, F.array(text))), parts, all_, TEMPLATES)
    out = _with_scores(out, one, "whole", whole_texts())
    good = lambda n: (n["score"] >= MIN_COSINE) & _versioned(n["text"], n["licence"])
    return (
        out.withColumn("notices", F.filter(all_, good))
        .withColumn("whole", F.filter("whole", lambda n: n["score"] >= WHOLE_COSINE))
        .drop(parts, all_, one)
    )


RESULTS = ("path", "licence", "score", "origin", "from_path")


def licences(files: DataFrame, path_col: str = "path", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per file: ``keep`` columns, path, licence, score, origin (own, inherited, disputed, none), from_path."""
    kept = {hidden("kept"): c for c in keep}
    shown = [F.col(k).alias(f"kept_{c}" if c in RESULTS else c) for k, c in kept.items()]
    keep = tuple(kept)
    read = files.select(*[F.col(c).alias(k) for k, c in kept.items()], F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    got = _with_licences(read, "text")
    rank = lambda n, r: F.struct(r.alias("r"), (-n["score"]).alias("s"), n["licence"].alias("licence"))
    best = F.array_sort(
        F.concat(
            F.transform("whole", lambda n: rank(n, F.lit(0))),
            F.transform("notices", lambda n: rank(n, F.when(n["licence"] == "proprietary", 2).otherwise(1))),
        )
    )
    own = materialise(
        got.select(
            *keep,
            "path",
            F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"),
            F.get(best, F.lit(0))["licence"].alias("licence"),
            (-F.get(best, F.lit(0))["s"]).alias("score"),
            F.coalesce((F.size("whole") > 0) | F.regexp_like(F.regexp_extract("path", "([^/]*)$", 1), F.lit(FILE_NAME)), F.lit(False)).alias("is_file"),
        ),
        "notices",
    )
    speaks = own.filter("is_file and licence is not null and path is not null").groupBy("dir").agg(
        F.min(F.struct((-F.col("score")).alias("s"), F.col("licence"))).alias("m"),
        F.min("licence").alias("low"),
        F.max("licence").alias("high"),
    )
    agreed = F.when(F.col("low") == F.col("high"), F.col("m.licence"))
    speaks = speaks.select(F.col("dir").alias("above"), F.struct(F.col("m.s"), agreed.alias("licence")).alias("m"))
    dirs = own.filter("path is not null").groupBy("dir").agg(F.count(F.lit(1)).alias("files"))
    parts = F.split("dir", "/", -1)
    up = dirs.select(
        "dir",
        "files",
        F.explode(F.sequence(F.lit(1), F.size(parts))).alias("depth"),
    ).withColumn("above", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    given = materialise(
        up.join(speaks, "above", "left")
        .groupBy("dir", "files")
        .agg(F.max(F.when(F.col("m").isNotNull(), F.struct("depth", "above", "m"))).alias("g"))
        .select("dir", "files", F.col("g.above").alias("above"), F.col("g.m.licence").alias("given"), (-F.col("g.m.s")).alias("given_score")),
        "inherited",
    )
    nowhere = own.filter("path is null").select(
        "*", F.lit(None).cast("string").alias("above"), F.lit(None).cast("string").alias("given"), F.lit(None).cast("double").alias("given_score")
    )
    joined = join_split(own.filter("path is not null"), given, "dir", "files").unionByName(nowhere)
    has, inherits, reached = F.col("licence").isNotNull(), F.col("given").isNotNull(), F.col("above").isNotNull()
    return joined.select(
        *shown,
        "path",
        F.coalesce("licence", "given").alias("licence"),
        F.when(has, F.col("score")).when(inherits, F.col("given_score")).alias("score"),
        F.when(has, "own").when(inherits, "inherited").when(reached, "disputed").otherwise("none").alias("origin"),
        F.when(has, F.col("path")).otherwise(F.col("above")).alias("from_path"),
    )
