"""License scans by diagonal voting, in DataFrame expressions only.

Every run of k words of a text is hashed and joined with the places where a license
template has the same run. Text position less template position is a diagonal; the hits of
a template are counted per diagonal. A text that quotes a template with some words put in or
left out has hits on neighbouring diagonals, so these are merged where they also follow each
other in the text. A merged span is a find if its hits cover ``MIN_COVER`` of the template
within a text stretch that is at most ``MAX_STRETCH`` times as long, unless another template
stands there more completely. Short phrases must stand
complete, on one diagonal; each of their places counts.

The runs that no template has are left out before the join by a look-up in the set of
template hashes, which is a constant of the query; so only hits are exploded. The hits carry
their words, and the join compares these too. Texts are read once and not shuffled. A hot
template is no hot key: hits are grouped by document and template, and a document's hits are
bounded by its own length.

Defined cases: null or empty text has no words and no labels; repeated rows give repeated
results (rows with equal id and text are alike); other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tasteloom.llm.base import saved, scratch
from tasteloom.llm.license_texts import NOTICES

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of a run for templates of so many words or more, and for shorter ones.
LONG_RUN, SHORT_RUN = 5, 2
MIN_COVER = 0.8
MAX_STRETCH = 1.3
#: Diagonals apart at most, and words between hits at most, to be merged.
DIAGONALS = 8
GAP = 24
#: Words of a stretch in which overlapping spans meet.
STRETCH = 64
#: Words of all templates together.
MOST_WORDS = 200_000


@dataclass(frozen=True)
class Template:
    """``base`` templates are phrases: all their words in a row, every place counted."""

    label: str
    text: str
    base: bool = False

    def words(self) -> list[str]:
        return re.findall(WORD, self.text.translate(str.maketrans(UPPER, UPPER.lower())))

    def run(self) -> int:
        return LONG_RUN if len(self.words()) > LONG_RUN else SHORT_RUN


#: The phrases of the contract, and public license notices.
TEMPLATES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
    Template(
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software.",
    ),
    Template(
        "apache-notice",
        "you may not use this file except in compliance with the License. You may obtain a "
        "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
        "express or implied.",
    ),
    Template(
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    Template(
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0"),
    Template("all-rights-reserved", "all rights reserved"),
    *(Template(label, text) for label, text in NOTICES.items()),
)


def read_templates(spark: SparkSession, folder: str) -> tuple[Template, ...]:
    """A template per text file of ``folder``, labelled by its name without the ending.

    Templates are constants of a scan, so all of them together may have ``MOST_WORDS`` words;
    more is an error. A file of fewer words than ``SHORT_RUN`` is one too: nothing could match it.
    """
    files = spark.read.text(folder, wholetext=True).select(
        F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?$", 1).alias("label"), "value"
    )
    words = files.agg(F.sum(F.regexp_count(lowered(F.col("value")), F.lit(WORD)))).first()[0] or 0
    if words > MOST_WORDS:
        raise ValueError(f"{words} words of license texts; {MOST_WORDS} are possible")
    found = [Template(r["label"], r["value"]) for r in files.orderBy("label", "value").collect()]
    for template in found:
        if len(template.words()) < SHORT_RUN:
            raise ValueError(f"license text {template.label} has fewer than {SHORT_RUN} words")
    return tuple(found)


def lowered(text: Column) -> Column:
    """A-Z as a-z, and nothing else."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _hash(k: int, words: list[Column]) -> Column:
    return F.xxhash64(F.lit(k), *words)


def template_runs(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """``t, at, k, h, run``: every run of every template; as many rows as templates have words."""
    rows = []
    for t, template in enumerate(templates):
        words, k = template.words(), template.run()
        rows += [(t, i, k, words[i : i + k]) for i in range(len(words) - k + 1)]
    found = spark.createDataFrame(rows, "t int, at int, k int, words array<string>")
    hashes = {
        k: _hash(k, [F.get("words", F.lit(j)) for j in range(k)]) for k in (SHORT_RUN, LONG_RUN)
    }
    h = F.when(F.col("k") == SHORT_RUN, hashes[SHORT_RUN]).otherwise(hashes[LONG_RUN])
    return found.select("t", "at", "k", h.alias("h"), F.array_join("words", " ").alias("run"))


def _runs(words: Column, k: int, wanted: list[int]) -> Column:
    """``pos, h, run`` of the runs of a text that some template has."""
    n = F.size(words)
    all_runs = F.transform(
        F.sequence(F.lit(0), n - k),
        lambda i: F.struct(i.alias("pos"), _hash(k, [F.get(words, i + j) for j in range(k)]).alias("h")),
    )
    found = F.transform(
        F.filter(all_runs, lambda r: r["h"].isin(wanted)),
        lambda r: F.struct(
            r["pos"].alias("pos"),
            r["h"].alias("h"),
            F.array_join(F.slice(words, r["pos"] + 1, k), " ").alias("run"),
        ),
    )
    empty = F.array().cast("array<struct<pos:int,h:bigint,run:string>>")
    return F.when(n >= k, found).otherwise(empty)


def _hits(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """A row per hit, and one without a template per document row, with its word count."""
    spark = docs.sparkSession
    runs = template_runs(spark, templates)
    known = runs.select("k", "h").distinct().collect()
    wanted = {k: [r["h"] for r in known if r["k"] == k] for k in (SHORT_RUN, LONG_RUN)}
    text = lowered(F.coalesce(F.col("text"), F.lit("")))
    split = docs.select(
        "doc_id",
        F.xxhash64("text").alias("_row"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"),
    )
    words = F.col("_words")
    none = F.array(
        F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("bigint").alias("h"), F.lit("").alias("run"))
    )
    lists = [_runs(words, k, found) for k, found in wanted.items() if found]
    rows = split.select(
        "doc_id", "_row", F.size(words).cast("bigint").alias("n_words"), F.inline(F.concat(none, *lists))
    )
    # The templates are constants of the program: some hundred rows, whatever the input.
    same = (F.col("h") == F.col("_h")) & (F.col("run") == F.col("_run"))
    places = F.broadcast(runs.withColumnsRenamed({"h": "_h", "run": "_run"}))
    return rows.join(places, same, "left").select(
        "doc_id", "_row", "n_words", "pos", "t", "at", "k"
    ).filter(F.col("t").isNotNull() | (F.col("pos") < 0))


def _covered(places: Column, k: Column) -> Column:
    """Template words under the runs that begin at the given sorted places."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-1000).alias("end"))
    return F.aggregate(
        places,
        start,
        lambda acc, at: F.struct(
            (acc["n"] + at + k - F.greatest(at, acc["end"])).cast("int").alias("n"),
            (at + k).cast("int").alias("end"),
        ),
        lambda acc: acc["n"],
    )


def _unrivalled(found: DataFrame) -> DataFrame:
    """``found`` without the spans in which another template stands more completely.

    Notices of one family share most of their words. A span gives way to one of another template
    that has a higher cover and ``MIN_COVER`` of its words. The two meet where the middle of the
    first is, by stretches of ``STRETCH`` words: a span is in as many as its template is long.
    """
    found = saved(found, f"{scratch(found.sparkSession, 'licenses')}/spans")
    middle = F.floor((F.col("start") + F.col("end")) / 2)
    rivals = found.select(
        *(F.col(name).alias(f"_{name}") for name in ("doc_id", "t", "start", "end", "cover")),
        F.col("_row").alias("_of"),
        F.explode(F.sequence(F.floor(F.col("start") / STRETCH), F.floor(F.col("end") / STRETCH))).alias("_at"),
    )
    common = F.least("end", "_end") - F.greatest("start", "_start")
    beaten = (
        F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        & (F.col("_row") == F.col("_of"))
        & (F.floor(middle / STRETCH) == F.col("_at"))
        & (F.col("t") != F.col("_t"))
        & (F.col("_cover") > F.col("cover"))
        & (common >= MIN_COVER * (F.col("end") - F.col("start")))
    )
    return found.join(rivals, beaten, "left_anti")


def spans(hits: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """``doc_id, _row, label, base, start, n_words, cover``: verified spans."""
    spark = hits.sparkSession
    facts = spark.createDataFrame(
        [(i, t.label, t.base, len(t.words())) for i, t in enumerate(templates)],
        "t int, label string, base boolean, length int",
    )
    lines = (
        hits.filter(F.col("t").isNotNull())
        .groupBy("doc_id", "_row", "t", "k", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(
            F.sort_array(F.collect_set("at")).alias("at"),
            F.min("pos").alias("start"),
            (F.max("pos") + F.first("k")).alias("end"),
        )
        .join(F.broadcast(facts), "t")
    )
    whole = lines.filter(F.col("base") & (F.size("at") == F.col("length") - F.col("k") + 1))
    keys = ["doc_id", "_row", "t", "_near"]
    # Neighbouring diagonals first: one far away, of a few words that the text repeats, may
    # begin anywhere between them without cutting what they form.
    side = Window.partitionBy(*keys[:-1]).orderBy("diagonal", "start")
    far = F.col("diagonal") - F.lag("diagonal").over(side) > DIAGONALS
    order = Window.partitionBy(*keys).orderBy("start", "diagonal")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    apart = (
        (F.col("start") > F.max("end").over(before) + GAP)
        # The template begins again behind what was found so far.
        | (
            (F.col("start") >= F.max("end").over(before))
            & (F.element_at("at", 1) < F.lag(F.element_at("at", -1)).over(order))
        )
    )
    merged = (
        lines.filter(~F.col("base"))
        .withColumn("_far", F.coalesce(far, F.lit(True)).cast("int"))
        .withColumn("_near", F.sum("_far").over(side))
        .withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("_span", F.sum("_new").over(order))
        .groupBy(*keys, "_span", "label", "base", "length", "k")
        .agg(
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("at")))).alias("at"),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
        )
        .withColumn("cover", _covered(F.col("at"), F.col("k")) / F.col("length"))
        .filter(
            (F.col("cover") >= MIN_COVER)
            & (F.col("end") - F.col("start") <= F.ceil(F.col("length") * MAX_STRETCH))
        )
    )
    columns = ["doc_id", "_row", "label", "base", "start"]
    size = (F.col("end") - F.col("start")).alias("n_words")
    return whole.select(*columns, size, F.lit(1.0).alias("cover")).unionByName(
        _unrivalled(merged).select(*columns, size, "cover")
    )


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per document: words, places of base phrases, labels, and the best cover as score."""
    hits = saved(_hits(docs, templates), f"{scratch(docs.sparkSession, 'licenses')}/hits")
    found = spans(hits, templates)
    base = F.col("base")
    per_doc = found.groupBy(F.col("doc_id").alias("_id"), F.col("_row").alias("_r")).agg(
        F.sum(base.cast("bigint")).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
    )
    rows = hits.filter(F.col("pos") < 0).select("doc_id", "_row", "n_words")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_r"))
    return rows.join(per_doc, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
