"""Licences of files by TF-IDF cosine to templates, and of their directories by inheritance.

Each line of a file, each paragraph (neighbouring lines without a blank one between them, as a wrapped
header has) and the text as a whole is a sparse vector of word weights, set against templates: notices,
standard headers, paragraphs of licence texts and SPDX tags. Weights follow from how many of the files
hold a word, counted by Spark. A file takes the licence of its best part; a file that is a notice as a whole,
or is named as licence files are, speaks for its directory, and a file without a licence of its own
inherits from the nearest directory above that has one. Spark functions only; what is broadcast is made of the
templates, whatever the files.

Most parts share only everyday words with the templates. The cosine to a template is at most the length
of the template's vector over the words that a part has in common with it, so other parts drop out exactly before
any word is shuffled, and whole texts before that, as they lack all words without which none gets there.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daystrata.sources.files import checkpointed, fits_broadcast

#: Notices, standard headers, paragraphs of licence texts, and SPDX tags.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
     "License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This file is subject to the Mozilla Public License, version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
     "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Cosine from which a part counts as a notice.
THRESHOLD = 0.6

_WORDS = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: Between paragraphs: lines without a letter or digit, as comment signs leave them.
_BLANK = r"\n(?:[^\p{L}0-9\n]*\n)+"
#: Names of files that speak for their directory if they hold a notice anywhere.
_SPEAKS = "(?i)(?:^|/)(?:un)?(?:licen[cs]e|copying|notice)[^/]*$"
_LINE, _PARAGRAPH, _WHOLE = range(3)


def words_of(text: str) -> list[str]:
    return re.findall(_WORDS, text.lower())


def weights(counts: Mapping[str, int], files: int) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the templates' words, given how many of the files hold each, and that
    of all other words, which weigh as if no file had them."""
    return {w: math.log((1 + files) / (1 + n)) + 1 for w, n in sorted(counts.items())}, math.log(1 + files) + 1


def vectors(templates: Sequence[tuple[str, str]], idf: Mapping[str, float]) -> list[dict[str, float]]:
    """Each template's words and weights, of length one."""
    out = []
    for _, text in templates:
        raw = {w: n * idf[w] for w, n in sorted(Counter(words_of(text)).items())}
        length = math.sqrt(sum(x * x for x in raw.values()))
        out.append({w: x / length for w, x in raw.items()})
    return out


def needed(known: Sequence[Mapping[str, float]], threshold: float, counts: Mapping[str, int] | None = None) -> list[str]:
    """Words of which a text must hold one to reach the threshold with any template: without them the cosine
    is at most the length of the template's other words. Words that few files hold are taken first, so that
    everyday ones need not be asked for."""
    left = [dict(vector) for vector in known]
    chosen: list[str] = []
    while open_ := [v for v in left if sum(x * x for x in v.values()) >= threshold**2 * 0.98]:
        gain = Counter()
        for vector in open_:
            for word, weight in vector.items():
                gain[word] += weight**2
        word = min(gain, key=lambda w: ((counts or {}).get(w, 0), -gain[w], w))
        chosen.append(word)
        for vector in left:
            vector.pop(word, None)
    return sorted(chosen)


def document_counts(texts: DataFrame, vocabulary: Sequence[str]) -> tuple[dict[str, int], int]:
    """How many rows of ``text`` hold each word of the vocabulary, and how many rows there are. Partial sums
    per word; the driver gets one row for each."""
    held = F.array_intersect(_words(F.lower("text")), F.array(*map(F.lit, vocabulary)))
    # The empty word, which is none, counts rows.
    every = texts.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("word"))
    found = {row["word"]: row["n"] for row in every.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {word: found.get(word, 0) for word in vocabulary}, found.get("", 0)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_WORDS), F.lit(0))


def _folder(path: Column) -> Column:
    """The directory of a path, with its closing slash; empty for a path without one."""
    return F.regexp_extract(path, "^(.*/)", 1)


def scan(
    files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """``(doc_id, path, own, score, part, place, inherited, inherited_from, licence)`` for every row.

    ``files``: ``(doc_id, path, text)``. ``own`` is the licence of the part most like a template, if the
    cosine reaches the threshold; ``part`` is 0 for a line, 1 for a paragraph of several lines and 2 for the
    whole text, ``place`` its number from 0. Of equals the first kind, then the first place, then the licence
    first by name counts. ``inherited`` comes from the nearest directory on the path with a file that speaks
    for it, the most alike one there; ``licence`` is the own one, else the inherited. Null text counts as empty, a
    null path inherits nothing; texts are searched whole; rows alike in id, path and text get the same answer,
    each its own row, and each counts for the words' weights; an empty table gives no rows; other columns are
    ignored.
    """
    spark = files.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    path = F.col("path").cast("string")
    key = [F.xxhash64(F.col("doc_id"), path).alias("a"), F.xxhash64(text).alias("b")]
    files = files.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), path.alias("path"), text.alias("text"), *key
    )
    vocabulary = sorted({word for _, template in templates for word in words_of(template)})
    counts, n = document_counts(files, vocabulary)
    idf, rare = weights(counts, n)
    known = vectors(templates, idf)
    wanted = needed(known, threshold, counts)

    def hopeful(column: Column) -> Column:
        some = F.lit(False)
        for word in wanted:
            some |= F.contains(column, F.lit(word))
        return some

    low = files.select("a", "b", F.lower("text").alias("text")).where(hopeful(F.col("text")))
    # No part holds more words than the text.
    low = low.withColumn("words", _words(F.col("text")))
    low = low.where(_bound("words", vocabulary, known) >= threshold**2 - 1e-6).drop("words")
    # Rows alike count once here, as the answer is theirs together.
    low = low.dropDuplicates(["a", "b"])

    def parts_by(kind: int, separator: str) -> DataFrame:
        pieces = F.posexplode(F.split("text", separator)).alias("place", "text")
        return low.select("a", "b", F.lit(kind).alias("part"), pieces)

    several = parts_by(_PARAGRAPH, _BLANK).where(F.contains("text", F.lit("\n")))
    whole = low.select("a", "b", F.lit(_WHOLE).alias("part"), F.lit(0).alias("place"), "text")
    parts = parts_by(_LINE, "\n").unionAll(several).unionAll(whole).where(hopeful(F.col("text")))
    parts = parts.select("a", "b", "part", "place", _words(F.col("text")).alias("words"))
    parts = parts.where(_bound("words", vocabulary, known) >= threshold**2 - 1e-6)
    terms = parts.select("a", "b", "part", "place", F.explode("words").alias("word"))
    at = ["a", "b", "part", "place"]
    counted = terms.groupBy(*at, "word").agg(F.count("*").alias("n"))
    rows = [
        (word, idf[word], [(i, vector[word]) for i, vector in enumerate(known) if word in vector])
        for word in vocabulary
    ]
    table = spark.createDataFrame(rows, "word string, idf double, in array<struct<t: int, x: double>>")
    weighed = counted.join(F.broadcast(table), "word", "left").select(
        *at, "in", (F.col("n") * F.coalesce("idf", F.lit(rare))).alias("w")
    )
    lengths = weighed.groupBy(*at).agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("length"))
    products = weighed.select(*at, "w", F.explode("in").alias("t"))
    dots = products.groupBy(*at, "t.t").agg(F.sum(F.col("w") * F.col("t.x")).alias("dot"))
    names = F.array(*[F.lit(name) for name, _ in templates])
    scored = dots.join(lengths, at).select(
        *at, F.get(names, F.col("t")).alias("name"), F.round(F.col("dot") / F.col("length"), 6).alias("score")
    )
    # The best is the least of (less alike, kind, place, name).
    place = F.struct((-F.col("score")).alias("s"), "part", "place", "name")
    found = scored.where(F.col("score") >= threshold).groupBy("a", "b").agg(
        F.min(place).alias("own"), F.min(F.when(F.col("part") == _WHOLE, place)).alias("whole")
    )
    found = checkpointed(found)
    rows = files.select("doc_id", "path", "a", "b").join(found, ["a", "b"], "left")
    folder = _folder(F.col("path"))
    speaks = F.coalesce(F.col("whole"), F.when(F.col("path").rlike(_SPEAKS), F.col("own")))
    notices = rows.select(folder.alias("above"), speaks.alias("best")).where("best is not null and above is not null")
    notices = notices.groupBy("above").agg(F.min(F.struct("best.s", "best.name"))["name"].alias("inherited"))
    # Directories, not files, look upwards: each joins its own ancestors.
    folders = files.select(folder.alias("folder")).where("folder is not null").distinct()
    pieces = F.expr("filter(split(folder, '/'), (p, i) -> i < size(split(folder, '/')) - 1)")
    above = F.transform(
        F.sequence(F.lit(0), F.size("pieces")),
        lambda k: F.concat(
            F.array_join(F.slice("pieces", F.lit(1), k), "/"), F.when(k > 0, F.lit("/")).otherwise("")
        ),
    )
    upward = folders.withColumn("pieces", pieces).select(
        "folder", F.explode(F.array_distinct(above)).alias("above")
    )
    nearest = upward.join(notices, "above").groupBy("folder").agg(
        F.max(F.struct(F.length("above").alias("n"), "above", "inherited")).alias("near")
    )
    nearest = nearest.select("folder", F.col("near.above").alias("inherited_from"), "near.inherited")
    if fits_broadcast(nearest.select(F.concat("folder", "inherited_from", "inherited").alias("all")), "all"):
        nearest = F.broadcast(nearest)
    return rows.join(nearest, folder == F.col("folder"), "left").select(
        "doc_id", "path",
        F.col("own.name").alias("own"),
        (-F.col("own.s")).alias("score"),
        F.col("own.part").alias("part"),
        F.col("own.place").alias("place"),
        "inherited",
        "inherited_from",
        F.coalesce("own.name", "inherited").alias("licence"),
    )


def _bound(words: str, vocabulary: Sequence[str], known: Sequence[Mapping[str, float]]) -> Column:
    """The largest square of the length of any template's vector over the words that are there."""
    squares = {word: [vector.get(word, 0.0) ** 2 for vector in known] for word in vocabulary}
    # As one constant; as an expression it would be thousands of them.
    table = F.from_json(F.lit(json.dumps(squares)), "map<string, array<double>>")
    held = F.array_intersect(F.col(words), F.array(*map(F.lit, vocabulary)))
    nothing = F.array(*[F.lit(0.0)] * len(known))
    sums = F.aggregate(
        held, nothing, lambda total, word: F.zip_with(total, F.element_at(table, word), lambda x, y: x + y)
    )
    return F.array_max(sums)


def scan_sql(
    files: str, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> str:
    """The same in DuckDB, weights included, without leaving anything out beforehand. ``files`` selects
    ``doc_id, path, text``."""
    values = ", ".join(
        f"({i}, '{name}', '{word}', {n})"
        for i, (name, text) in enumerate(templates)
        for word, n in sorted(Counter(words_of(text)).items())
    )
    return f"""
    with files as (select row_number() over () as r, doc_id, path, lower(coalesce(text, '')) as text
        from ({files})),
    given as (select * from (values {values}) v(t, name, word, n)),
    held as (select distinct r, unnest(regexp_extract_all(text, '{_WORDS}')) as word from files),
    counts as (select word, count(*) as k from held where word in (select word from given) group by word),
    total as (select count(*) as n from files),
    idf as (select distinct word, ln((1 + total.n) / (1 + coalesce(k, 0))) + 1 as idf
      from given left join counts using (word), total),
    known as (select t, name, word, given.n * idf / sqrt(sum((given.n * idf) ** 2) over (partition by t)) as x
      from given join idf using (word)),
    split as (select r, 0 as part, unnest(string_split(text, chr(10))) as piece,
        unnest(range(len(string_split(text, chr(10))))) as place from files),
    cut as (select r, 1 as part, unnest(string_split_regex(text, '{_BLANK}')) as piece,
        unnest(range(len(string_split_regex(text, '{_BLANK}')))) as place from files),
    parts as (select * from split union all select * from cut where contains(piece, chr(10))
      union all select r, 2, text, 0 from files),
    terms as (select r, part, place, unnest(regexp_extract_all(piece, '{_WORDS}')) as word from parts),
    counted as (select r, part, place, word, count(*) as n from terms group by all),
    weighed as (select r, part, place, word, counted.n * coalesce(idf, ln(1 + total.n) + 1) as w
      from counted left join idf using (word), total),
    lengths as (select r, part, place, sqrt(sum(w * w)) as length from weighed group by all),
    scored as (select r, part, place, t, any_value(name) as name, round(sum(w * x) / any_value(length), 6) as score
      from weighed join known using (word) join lengths using (r, part, place) group by r, part, place, t),
    good as (select * from scored where score >= {threshold}),
    own as (select * from good
      qualify row_number() over (partition by r order by score desc, part, place, name) = 1),
    whole as (select * from good where part = 2
      qualify row_number() over (partition by r order by score desc, name) = 1),
    spoken as (select regexp_extract(path, '^(.*/)', 1) as above, coalesce(whole.name, own.name) as name,
        coalesce(whole.score, own.score) as score
      from files left join whole using (r) left join own using (r)
      where path is not null and (whole.r is not null or own.r is not null and regexp_matches(path, '{_SPEAKS}'))),
    notices as (select above, name from spoken
      qualify row_number() over (partition by above order by score desc, name) = 1),
    near as (select f.r, n.name as inherited, n.above from files f join notices n
      on starts_with(regexp_extract(f.path, '^(.*/)', 1), n.above)
      qualify row_number() over (partition by f.r order by length(n.above) desc) = 1)
    select f.doc_id, f.path, own.name as own, own.score, own.part::int as part, own.place::int as place,
      near.inherited, near.above as inherited_from, coalesce(own.name, near.inherited) as licence
    from files f left join own using (r) left join near using (r)
    """
