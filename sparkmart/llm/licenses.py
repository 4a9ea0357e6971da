"""License scan by a positional rare-token index (operator 1).

1. One scan turns each text into its number of words and its *licence hits*: positions and words of
   the words that occur in any template.  The hits are stored; texts are not read again.
2. Document frequencies of those words are counted over all documents.  The index holds, for the word of
   highest IDF of each template's key phrase, a posting of the template and the word's position in it.  The
   key phrase must stand whole, so every place that can count holds that word, whatever the other words of
   the text or the corpus.
3. The rarest words of a document are looked up in the index, which is joined by broadcast: each meeting
   proposes one relative position of a template.  The template's other words are intersected with the
   hits around it at that position.
4. A proposal counts when the mandatory key phrase stands there word for word and the share of
   matching words reaches ``min_cover``.  Base phrases are their own key phrase, so all their places
   are found: each holds the indexed word at its place.

The templates are rows of a table, not columns of the plan, so hundreds cost no more plan than one.

Cases: null and empty texts have no words and no labels; the order and number of rows, null or
repeated ids and further columns are kept apart from the text; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import store

#: A word of a lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str  # mandatory phrase, part of text
    base: bool = False


#: Names of licences after "SPDX-License-Identifier:".
SPDX = ("0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
        "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1",
        "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "WTFPL", "Zlib")

#: The base phrases, then notices and grants as their licences word them.
TEMPLATES = (
    Template("gpl", "gnu general public license", "gnu general public license", base=True),
    Template("apache", "apache license", "apache license", base=True),
    Template("cc-by", "cc by", "cc by", base=True),
    Template("mit", "mit license", "mit license", base=True),
    Template("gpl-3.0", "licensed under the gnu general public license version 3",
             "gnu general public license version 3"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2",
             "gnu general public license version 2"),
    Template("lgpl", "licensed under the gnu lesser general public license",
             "gnu lesser general public license"),
    Template("agpl", "licensed under the gnu affero general public license",
             "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0",
             "apache license version 2 0"),
    Template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    Template("cc0", "licensed under cc0 1 0 universal", "cc0 1 0"),
    Template("mit-release", "released under the mit license", "under the mit license"),
    Template("mit-grant", "permission is hereby granted free of charge to any person obtaining a "
             "copy of this software", "permission is hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification "
             "are permitted", "redistribution and use in source and binary forms"),
    Template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    Template("epl", "made available under the terms of the eclipse public license",
             "eclipse public license"),
    Template("unlicense", "free and unencumbered software released into the public domain",
             "free and unencumbered software"),
    Template("reserved", "all rights reserved", "all rights reserved"),
    Template("mit", "mit licence", "mit licence"),
    Template("apache", "apache licence", "apache licence"),
    Template("gpl", "gnu general public licence", "gnu general public licence"),
    Template("gpl", "gnu gpl", "gnu gpl"),
    Template("gpl-3.0", "gplv3", "gplv3"),
    Template("gpl-2.0", "gplv2", "gplv2"),
    Template("bsd-2-clause", "bsd 2 clause", "bsd 2 clause"),
    Template("bsd-3-clause", "bsd 3 clause", "bsd 3 clause"),
    Template("isc", "isc license", "isc license"),
    Template("cc-by", "creative commons attribution", "creative commons attribution"),
    Template("cc-by-sa", "creative commons attribution share alike", "attribution share alike"),
    Template("cc-by-sa", "creative commons attribution sharealike", "attribution sharealike"),
    Template("cc-by-nc", "creative commons attribution non commercial", "attribution non commercial"),
    Template("cc-by-nc", "creative commons attribution noncommercial", "attribution noncommercial"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this "
             "software and associated documentation files the software to deal in the software without "
             "restriction including without limitation the rights to use copy modify merge publish distribute "
             "sublicense and or sell copies of the software and to permit persons to whom the software is "
             "furnished to do so subject to the following conditions the above copyright notice and this "
             "permission notice shall be included in all copies or substantial portions of the software",
             "to deal in the software without restriction"),
    Template("bsd-text", "redistribution and use in source and binary forms with or without modification are "
             "permitted provided that the following conditions are met 1 redistributions of source code must "
             "retain the above copyright notice this list of conditions and the following disclaimer 2 "
             "redistributions in binary form must reproduce the above copyright notice this list of conditions "
             "and the following disclaimer in the documentation and or other materials provided with the "
             "distribution", "redistributions of source code must retain the above copyright notice"),
    Template("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be "
             "used to endorse or promote products derived from this software without specific prior written "
             "permission", "used to endorse or promote products derived from this software"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or "
             "without fee is hereby granted provided that the above copyright notice and this permission notice "
             "appear in all copies", "for any purpose with or without fee is hereby granted"),
    Template("zlib", "permission is granted to anyone to use this software for any purpose including commercial "
             "applications and to alter it and redistribute it freely",
             "alter it and redistribute it freely"),
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file "
             "except in compliance with the license you may obtain a copy of the license at",
             "you may not use this file except in compliance with the license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of "
             "the gnu general public license as published by the free software foundation",
             "gnu general public license as published by the free software foundation"),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under the terms of "
             "the gnu lesser general public license as published by the free software foundation",
             "gnu lesser general public license as published by the free software foundation"),
    Template("agpl", "this program is free software you can redistribute it and or modify it under the terms of "
             "the gnu affero general public license as published by the free software foundation",
             "gnu affero general public license as published by the free software foundation"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
             "mozilla public license v 2 0"),
    Template("bsl-1.0", "boost software license version 1 0", "boost software license"),
    Template("wtfpl", "do what the fuck you want to public license", "do what the fuck you want to"),
    Template("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software "
             "either in source code form or as a compiled binary for any purpose commercial or non commercial "
             "and by any means", "anyone is free to copy modify publish use compile sell or distribute"),
    *(Template(name.lower(), text, text) for name in SPDX
      for text in ["spdx license identifier " + name.lower().replace("-", " ").replace(".", " ")]),
)


def key_place(template: Template) -> int:
    """Where the key phrase starts in the template's words."""
    words, key = template.text.split(), template.key.split()
    return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


def licence_hits(docs: DataFrame, vocabulary: list[str], *, id_col: str, text_col: str) -> DataFrame:
    """``row, id, n_words, hits``; hits are structs (p, w) of position and word, in text order."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = F.regexp_extract_all(
        F.translate(F.coalesce(F.col(text_col), F.lit("")), upper, lower), F.lit(WORD), F.lit(0))
    at = F.transform(F.col("words"), lambda w, i: F.when(w.isin(vocabulary), F.struct(
        i.alias("p"), w.alias("w"))))
    return (docs.select(F.col(id_col).alias("id"), words.alias("words"))
            .select(F.monotonically_increasing_id().alias("row"), "id",
                    F.size("words").cast("long").alias("n_words"),
                    F.filter(at, lambda h: h.isNotNull()).alias("hits")))


def rarest_words(templates: tuple[Template, ...], df: dict[str, int]) -> list[int]:
    """For each template the place of the word of its key phrase that the fewest documents hold."""
    places = []
    for t in templates:
        words, first = t.text.split(), key_place(t)
        places.append(min(range(first, first + len(t.key.split())), key=lambda i: (df.get(words[i], 0), i)))
    return places


def index(spark: SparkSession, templates: tuple[Template, ...], places: list[int]) -> DataFrame:
    """Postings ``w, a, words, first, n_key, label, base``: a rare word, its place in a template, and the
    template.  One row a template."""
    rows = ", ".join(f"('{t.text.split()[a]}', {a}, split('{t.text}', ' '), {key_place(t)}, "
                     f"{len(t.key.split())}, '{t.label}', {t.base})" for t, a in zip(templates, places))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(w, a, words, first, n_key, label, base)")


def places_found(hits: DataFrame, templates: tuple[Template, ...], places: list[int],
                 min_cover: float) -> DataFrame:
    """``row, start, label, base, share``: every place of a template that counts."""
    rare = ", ".join(sorted({f"'{t.text.split()[a]}'" for t, a in zip(templates, places)}))
    # Hits have distinct ascending positions, so the words of a template around its rare word lie among as
    # many neighbours of that hit on either side.
    back = max(places)
    on = max(len(t.text.split()) - 1 - a for t, a in zip(templates, places))
    rows = hits.where(f"exists(hits, x -> x.w in ({rare}))").select("row", "hits", F.explode(F.expr(
        f"filter(sequence(1, size(hits)), j -> get(hits, j - 1).w in ({rare}))")).alias("j"))
    proposed = rows.selectExpr(
        "row", "get(hits, j - 1).p as p", "get(hits, j - 1).w as w",
        f"slice(hits, greatest(1, j - {back}), least(j - 1, {back}) + 1 + {on}) as near")
    met = proposed.join(F.broadcast(index(hits.sparkSession, templates, places)), "w").selectExpr(
        "row", "p - a as start", "label", "base", "size(words) as n", "first", "n_key",
        "transform(filter(near, x -> x.w = get(words, x.p - p + a)), x -> x.p - p + a) as same")
    whole = F.expr("size(filter(same, k -> k >= first and k < first + n_key)) = n_key")
    return (met.where(whole & (F.size("same") >= F.lit(min_cover) * F.col("n")))
            .select("row", "start", "label", "base", (F.size("same") / F.col("n")).alias("share")))


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, *,
                  min_cover: float = 0.75, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_words, n_base, first_word, last_word, base_labels, labels,
    score``; score is the largest share of a template's words found at one relative position, with
    its key phrase there."""
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    hits = store(licence_hits(docs, vocabulary, id_col=id_col, text_col=text_col), "licence-hits")
    # At most one row per word of the fixed templates comes back.
    df = {r.w: r.n for r in hits.select(F.explode(F.array_distinct("hits.w")).alias("w"))
          .groupBy("w").agg(F.count("*").alias("n")).collect()}
    found = (places_found(hits, templates, rarest_words(templates, df), min_cover).groupBy("row").agg(
        F.count_if("base").alias("n_base"),
        *[f(F.when(F.col("base"), F.col("start"))).cast("long").alias(name)
          for f, name in ((F.min, "first_word"), (F.max, "last_word"))],
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"), F.max("share").alias("score")))

    def joined(names: str) -> Column:
        return F.coalesce(F.array_join(F.array_sort(names), ","), F.lit("")).alias(names)

    return hits.select("row", "id", "n_words").join(found, "row", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", joined("base_labels"), joined("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
