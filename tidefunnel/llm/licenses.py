"""License scans: an exact containment join of text blocks with notice templates.

A block is a run of consecutive words of the text, wherever its lines end: for each
template, every run of as many words as the template has, and up to ``WIDEST`` times
as many.  A block holds a template if at least ``threshold`` of the template's
distinct words are in it, so a block has ``need`` words at least.  The join is exact
and runs on DataFrames only:

1. One pass over the texts counts words, finds the base phrases and keeps the places
   of words that any template has, for texts that hold enough words of some template
   at all (a condition that no match can fail).  The result is written.
2. The words of the templates are ordered by the number of documents that hold
   them, rarest first, over all documents.
3. Prefix filter: a match holds one of the first |T| - need + 1 words of the template.
   At each place of such a word, the words that the widest block of its templates
   around it can hold are handed on, and nothing else of the text.
4. Positional filter: the template's words near enough must suffice.  What remains is
   counted in the widest block from each of them on.

The templates are a short fixed list: the driver reads one count for each of their
words, and the plan holds them as literals, so there is no join but the last, by id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefunnel.llm.common import documents
from tidefunnel.operators.tables import staged

# Phrases whose words must stand together, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices and whole licence texts as their authors give them, lower case, words only.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-2", "licensed under the bsd 2 clause license"),
    ("bsd-3", "licensed under the bsd 3 clause license"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl-2", "made available under the terms of the eclipse public license 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 license"),
    ("cc-by-nd", "this work is licensed under cc by nd 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "copyright all rights reserved no part may be reproduced without written permission"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to"
        " permit persons to whom the software is furnished to do so subject to the following conditions the above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " software the software is provided as is without warranty of any kind express or implied including but not"
        " limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no"
        " event shall the authors or copyright holders be liable for any claim damages or other liability whether in"
        " an action of contract tort or otherwise arising from out of or in connection with the software or the use"
        " or other dealings in the software",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies the"
        " software is provided as is and the author disclaims all warranties with regard to this software including"
        " all implied warranties of merchantability and fitness in no event shall the author be liable for any special"
        " direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or"
        " profits whether in an action of contract negligence or other tortious action arising out of or in connection"
        " with the use or performance of this software",
    ),
    (
        "bsd-2",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met 1 redistributions of source code must retain the above copyright notice"
        " this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the"
        " above copyright notice this list of conditions and the following disclaimer in the documentation and or"
        " other materials provided with the distribution",
    ),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
        " the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required"
        " by applicable law or agreed to in writing software distributed under the license is distributed on an as is"
        " basis without warranties or conditions of any kind either express or implied see the license for the"
        " specific language governing permissions and limitations under the license",
    ),
)
THRESHOLD = 0.93  # of 13 words and less, all: a number or "lesser" tells notices apart
WIDEST = 1.5  # for marks of comments and inserted words; more would gather scattered words
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spaced(text: Column) -> Column:
    """The words, lower case, with one space before, between and behind them ("" for none)."""
    words = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), GAP, " "))
    return F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _need(template: str) -> int:
    return math.ceil(THRESHOLD * len(set(template.split())) - 1e-9)


def _width(template: str) -> int:
    return math.floor(WIDEST * len(template.split()) + 1e-9)


def _measured(plain: DataFrame) -> DataFrame:
    """One row for each document: word and phrase counts, template words, their places if possible."""
    own_words = sorted({w for _, t in TEMPLATES for w in t.split()})
    vocabulary = F.array(*(F.lit(w) for w in own_words))
    found = plain.select("doc_id", F.xxhash64("text").alias("content"), spaced(F.col("text")).alias("words"))
    words = F.col("words")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE.items():
        here = words.contains(f" {phrase} ")
        counts.append(F.when(here, F.regexp_count(words, F.lit(f" {phrase}(?= )"))).otherwise(0))
        before = F.substring_index(words, f" {phrase} ", 1)
        behind = F.substring_index(words, f" {phrase} ", -1)
        firsts.append(F.when(here, _spaces(before)))
        # words before the last place: all, without those of the phrase and behind it
        size = len(phrase.split())
        lasts.append(F.when(here, _spaces(words) - 1 - size - F.greatest(_spaces(behind), F.lit(0))))
        labels.append(F.when(here, F.lit(label)))
    hits = F.array_intersect(F.split(words, " "), vocabulary)
    enough = F.lit(False)
    for _, template in TEMPLATES:
        own = F.array(*(F.lit(w) for w in dict.fromkeys(template.split())))
        enough = enough | (F.size(F.array_intersect(F.col("hits"), own)) >= _need(template))
    places = F.transform(
        F.split(words, " "),
        lambda x, i: F.when(x.isin(own_words), F.struct(i.alias("at"), x.alias("word"))),
    )
    return (
        found.withColumn("hits", hits)
        .select(
            "doc_id",
            "content",
            F.greatest(_spaces(words) - 1, F.lit(0)).alias("n_words"),
            sum(counts[1:], counts[0]).cast("long").alias("n_base"),
            F.least(*firsts).alias("first_word"),
            F.greatest(*lasts).alias("last_word"),
            F.array_compact(F.array(*labels)).alias("base"),
            "hits",
            F.when(enough, F.array_compact(places)).alias("places"),
        )
    )


def _prefixes(table: DataFrame) -> dict[str, list[int]]:
    """The templates that each word is among the first of, in the global order.

    Words that no document holds come first: they are the rarest.
    """
    seen = table.select(F.explode("hits").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = {r.word: r.n for r in seen.collect()}  # at most the template words
    out: dict[str, list[int]] = {}
    for no, (_, template) in enumerate(TEMPLATES):
        ranked = sorted(set(template.split()), key=lambda w: (counts.get(w, 0), w))
        for word in ranked[: len(ranked) - _need(template) + 1]:
            out.setdefault(word, []).append(no)
    return out


def _of_template(values: list) -> Column:
    """The value of the row's template."""
    return F.element_at(F.array(*map(F.lit, values)), F.col("no") + 1)


def template_matches(table: DataFrame) -> DataFrame:
    """(doc_id, content, label, containment) of templates and the blocks around a prefix word."""
    prefixes = _prefixes(table)
    texts = [t for _, t in TEMPLATES]
    reaches = {w: max(_width(texts[no]) for no in nos) - 1 for w, nos in prefixes.items()}
    of_reach = F.create_map(*(F.lit(x) for pair in reaches.items() for x in pair))
    places = F.col("places")

    def around(p: Column, j: Column) -> Column:
        reach = F.element_at(of_reach, p["word"])
        first = F.greatest(j + 1 - reach, F.lit(1))
        near = F.slice(places, first, j + 2 + reach - first)
        return F.when(p["word"].isin(list(prefixes)), F.struct(p["at"].alias("at"), p["word"].alias("word"), near.alias("near")))

    probes = (
        table.where(F.size("places") > 0)
        .select("doc_id", "content", F.explode(F.array_compact(F.transform(places, around))).alias("p"))
        .select("doc_id", "content", "p.at", "p.word", "p.near")
    )
    of_word = F.create_map(*(x for w, nos in prefixes.items() for x in (F.lit(w), F.array(*map(F.lit, nos)))))
    near = F.filter(
        "near",
        lambda x: (F.abs(x["at"] - F.col("at")) < F.col("width")) & F.array_contains(F.col("own"), x["word"]),
    )
    pairs = (
        probes.withColumn("no", F.explode(F.element_at(of_word, F.col("word"))))
        .withColumns({
            "label": _of_template([label for label, _ in TEMPLATES]),
            "own": _of_template([list(dict.fromkeys(t.split())) for t in texts]),
            "need": _of_template(list(map(_need, texts))),
            "width": _of_template(list(map(_width, texts))),
        })
        .withColumn("near", near)
        .where(F.size(F.array_distinct("near.word")) >= F.col("need"))
    )

    def held(a: Column) -> Column:
        """Distinct words of the template in the widest block from ``a`` on."""
        block = F.filter("near", lambda b: (b["at"] >= a["at"]) & (b["at"] < a["at"] + F.col("width")))
        return F.size(F.array_distinct(F.transform(block, lambda b: b["word"])))

    return (
        pairs.withColumn("shared", F.array_max(F.transform("near", held)))
        .where("shared >= need")
        .select("doc_id", "content", "label", (F.col("shared") / F.size("own")).alias("containment"))
    )


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base phrases and template matches of each row of ``docs``.

    NULL and empty texts have no words, labels "" and score 0.  ``score`` is 1 where
    a base phrase stands, else the best containment of a block, else 0.  Rows of the
    same id and text share their result; a NULL id is matched as any other.
    """
    table = staged(_measured(documents(docs, id_col, text_col)), "license-words")
    matches = (
        template_matches(table)
        .groupBy("doc_id", "content")
        .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
        .withColumnsRenamed({"doc_id": "id", "content": "of"})
    )
    joined = table.drop("hits", "places").join(
        matches, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("of")), "left"
    )
    base = F.array_sort(F.array_distinct("base"))
    every = F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


# --- the same, plainly, for DuckDB ---------------------------------------------


def license_sql() -> str:
    """The best block of every text from each place of a template word on; without the filters."""
    gap = GAP
    words = f"list_filter(regexp_split_to_array(translate(%s, '{UPPER}', '{LOWER}'), '{gap}'), lambda x: x <> '')"
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in BASE.items())
    templates = ", ".join(
        f"({i}, '{label}', {_need(t)}, {_width(t)}, {list(dict.fromkeys(t.split()))})"
        for i, (label, t) in enumerate(TEMPLATES)
    )
    return f"""
    WITH phrase(p, label, n) AS (VALUES {phrases}),
    template(no, label, need, width, own) AS (VALUES {templates}),
    d AS (SELECT doc_id, coalesce(text, '') AS text, {words % "coalesce(text, '')"} AS w FROM documents),
    place AS (
        SELECT doc_id, label, i FROM d, phrase, unnest(range(0, len(w) - n + 1)) AS r(i)
        WHERE w[i + 1] = string_split(p, ' ')[1] AND array_to_string(w[i + 1 : i + n], ' ') = p
    ),
    base AS (
        SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels, list(DISTINCT label) AS bl
        FROM place GROUP BY doc_id
    ),
    own_word AS (SELECT no, label, need, width, len(own) AS size, unnest(own) AS word FROM template),
    near AS (
        SELECT doc_id, no, label, need, size, count(DISTINCT word) OVER (
            PARTITION BY doc_id, no ORDER BY i RANGE BETWEEN CURRENT ROW AND width - 1 FOLLOWING
        ) AS shared
        FROM (SELECT doc_id, unnest(range(0, len(w))) AS i, unnest(w) AS word FROM d) JOIN own_word USING (word)
    ),
    hit AS (
        SELECT doc_id, label, max(shared) / any_value(size) AS c
        FROM near WHERE shared >= need GROUP BY doc_id, no, label
    ),
    more AS (SELECT doc_id, list(DISTINCT label) AS ml, max(c) AS best FROM hit GROUP BY doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
           first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
           coalesce(base_labels, '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bl, []), coalesce(ml, [])))), ','), '') AS labels,
           CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0) END::DOUBLE AS score
    FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
    """
