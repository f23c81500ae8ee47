"""License scans by a positional index of rare licence words.

The words of a file that are rarest in the corpus among all licence words are
looked up in the postings of the licence templates; where enough of them stand
at the same distance from their places in a template, the template is a
candidate, and its mandatory phrases are verified. Base phrases are found
besides. All of it happens within a row, in column functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    mandatory: tuple[str, ...]


# Notices by which the licences are commonly stated, and the phrases that must be there.
TEMPLATES = (
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute this software",)),
)

#: Words of each template that the index holds: its rarest in the corpus (fewest documents, then by word).
RARE_PER_TEMPLATE = 8
#: Rarest licence words of a file that are looked up.
LOOKED_UP = 12
#: Words that must stand in place (fewer, if a template has fewer that are rare).
IN_PLACE = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal(text: Column) -> Column:
    """Words with one space before, between and after them; a lone space without words."""
    plain = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _GAP, " "))
    return F.when(plain == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), plain, F.lit(" ")))


def _spaces(x: Column) -> Column:
    return (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))).cast("long")


def _phrase(words) -> str:
    return "(?<= )(?:" + "|".join(map(re.escape, words)).replace(r"\ ", " ") + ")(?= )"


def document_frequencies(documents: DataFrame, templates=TEMPLATES) -> tuple[dict[str, int], int]:
    """In how many documents each licence word is, and the number of documents; the words are those of the templates."""
    words = sorted({w for t in templates for w in t.text.split()})
    own = F.concat(F.array_intersect(F.lit(words), F.split(normal(F.col("text")), " ")), F.array(F.lit("")))
    rows = documents.select(F.explode(own).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    found = {r["w"]: r["n"] for r in rows}
    return {w: found.get(w, 0) for w in words}, found.get("", 0)


def scanned(documents: DataFrame, frequencies: dict[str, int], total: int, templates=TEMPLATES) -> DataFrame:
    """documents with n_words, n_base, first_word, last_word, base_labels, labels and score.

    n_base counts the places of base phrases, first_word and last_word are the
    smallest and largest number of a word where one starts (null without any).
    labels has base labels and the templates'. Each template is indexed by its
    RARE_PER_TEMPLATE rarest words; a text looks up its LOOKED_UP rarest of them, the
    postings are intersected by relative position, and the template's mandatory
    phrases are verified last. score is the largest share of a found template's
    indexed words that stand in place; 0 without one. A null or
    empty text has no words and no labels. Repeated rows are scanned each; all other
    columns are kept, those with the names of results give way to them.
    """
    # Each template is indexed by its RARE_PER_TEMPLATE rarest words in the corpus, whatever the corpus size.
    rarity = {w: (frequencies.get(w, 0), w) for t in templates for w in t.text.split()}
    rare = sorted({w for t in templates for w in sorted(set(t.text.split()), key=rarity.get)[:RARE_PER_TEMPLATE]}, key=rarity.get)
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        for i, w in enumerate(template.text.split()):
            if w in rare:
                postings.setdefault(w, []).append((t, i))
    count = [sum(t == k for own in postings.values() for t, _ in own) for k in range(len(templates))]

    phrase = _phrase(BASE)
    out = documents.select(F.struct("*").alias("row"), normal(F.col("text")).alias("norm"))
    hits = F.when(F.col("norm").rlike(phrase), F.regexp_extract_all("norm", F.lit(phrase), F.lit(0)))
    out = out.withColumn("base_hits", F.coalesce(hits, F.expr("cast(array() as array<string>)")))
    has_base = F.size("base_hits") > 0
    pieces = F.split("norm", phrase, -1)
    first = F.when(has_base, _spaces(F.get(pieces, F.lit(0))) - 1)
    after = _spaces(F.element_at(pieces, -1)) + _spaces(F.element_at("base_hits", F.lit(-1)))
    last = F.when(has_base, _spaces(F.col("norm")) - after - 1)
    label_of = F.create_map(*[F.lit(x) for pair in BASE.items() for x in pair])
    base_labels = F.array_sort(F.array_distinct(F.transform("base_hits", lambda h: F.get(F.array(F.element_at(label_of, h)), F.lit(0)))))

    words = F.slice(F.split("norm", " "), 2, F.greatest(_spaces(F.col("norm")).cast("int") - 1, F.lit(0)))
    none = F.lit([0] * len(templates))
    in_place = none
    if postings:
        table = F.create_map(
            *[x for w, own in postings.items() for x in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for t, i in own]))]
        )
        known = F.slice(F.array_intersect(F.lit([w for w in rare if w in postings]), words), 1, LOOKED_UP)
        numbered = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))

        def run_of(state, x):
            run = F.when((x["t"] == state["t"]) & (x["o"] == state["o"]), state["run"] + 1).otherwise(F.lit(1))
            best = F.transform(state["best"], lambda b, i: F.when(i == x["t"], F.greatest(b, run)).otherwise(b))
            return F.struct(x["t"].alias("t"), x["o"].alias("o"), run.alias("run"), best.alias("best"))

        def best_runs(top: Column) -> Column:
            placed = F.filter(numbered, lambda p: F.array_contains(top, p["w"]))
            offsets = F.flatten(
                F.transform(placed, lambda p: F.transform(F.element_at(table, p["w"]), lambda q: F.struct(q["t"].alias("t"), (p["i"] - q["i"]).alias("o"))))
            )
            zero = F.struct(F.lit(-1).alias("t"), F.lit(0).alias("o"), F.lit(0).alias("run"), none.alias("best"))
            return F.aggregate(F.array_sort(offsets), zero, run_of, lambda s: s["best"])

        # candidates come from the postings of every text; the mandatory phrases are verified last
        out = out.withColumn("top", known)
        in_place = F.when(F.size("top") > 0, best_runs(F.col("top"))).otherwise(none)
    out = out.withColumn("in_place", in_place)

    found, scores = [], []
    for k, template in enumerate(templates):
        if not count[k]:
            continue
        good = F.get("in_place", F.lit(k)) >= min(IN_PLACE, count[k])
        for p in template.mandatory:
            good &= F.contains(F.col("norm"), F.lit(f" {p} "))
        found.append(F.when(good, F.lit(template.label)))
        scores.append(F.when(good, F.least(F.lit(1.0), F.get("in_place", F.lit(k)) / min(count[k], LOOKED_UP))).otherwise(F.lit(0.0)))
    own = F.array_compact(F.array(*found)) if found else F.expr("cast(array() as array<string>)")
    best = F.greatest(*scores, F.lit(0.0)) if scores else F.lit(0.0)
    out = out.withColumn("base_array", base_labels).withColumn("own_array", F.when(F.size("in_place") > 0, own))
    columns = [
        (_spaces(F.col("norm")) - 1).alias("n_words"),
        F.size("base_hits").cast("long").alias("n_base"),
        first.alias("first_word"),
        last.alias("last_word"),
        F.array_join("base_array", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base_array", "own_array"))), ",").alias("labels"),
        best.alias("score"),
    ]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return out.select(*[F.col("row")[c].alias(c) for c in documents.columns if c not in names], *columns)
