"""License scans by diagonal voting: word k-grams of documents meet those of templates, and the
difference of their places, the diagonal, gathers votes for one stretch of text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import ID_ROWS, ascii_lower, save, small
from millrace.llm.decontaminate import words_of

#: Words of a gram; a shorter template is one gram.
GRAM = 4
#: Words of documents whose grams leave a task in one batch, unless one text has more.
BATCH_WORDS = 1 << 17
#: Word hashes that a task remembers.
MEMO_WORDS = 1 << 17
#: Parts over which the rows of one text are spread when they meet its matches.
SALTS = 16
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Template:
    """A text that names a license. ``exact``: all its words, one after the other; otherwise
    ``percent`` of them, where words may be missing, changed or put in between."""

    label: str
    text: str
    exact: bool = False
    percent: int = 70

    @property
    def words(self) -> list[str]:
        return [w.decode() for w in words_of(self.text)]

    @property
    def gram(self) -> int:
        return min(GRAM, len(self.words))

    @property
    def width(self) -> int:
        """Neighbouring diagonals that count as one: an eighth of the template; none if it is exact."""
        return 0 if self.exact else max(1, len(self.words) // 8)


# The phrases of the base columns, and well-known license notices.
PHRASES = [
    Template("gpl", "gnu general public license", exact=True),
    Template("apache", "apache license", exact=True),
    Template("cc-by", "cc by", exact=True),
    Template("mit", "mit license", exact=True),
]
NOTICES = [
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied.",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
        "or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
]


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def gram_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash, never 0, of every ``size`` consecutive words, given as hashes."""
    out = np.full(max(0, len(codes) - size + 1), np.uint64(size))
    for i in range(size):
        out = (out ^ (out >> np.uint64(29))) * _PRIME + codes[i : i + len(out)]
    return (out | np.uint64(1)).view(np.int64)


def _coded(words: list[bytes], known: _Codes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _grams(sizes: Sequence[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names = _Codes(), ["digest", "key", "n_words", "grams"]
        for batch in batches:
            first, counts, lists, held = 0, [], [], 0
            for row, text in enumerate(batch.column(2)):
                words = words_of(text.as_py())
                codes = _coded(words, known)
                counts.append(len(words))
                lists.append(np.concatenate([np.zeros(1, np.int64), *[gram_hashes(codes, size) for size in sizes]]))
                held += len(words)
                if held >= BATCH_WORDS or row == batch.num_rows - 1:
                    offsets = np.cumsum([0, *map(len, lists)])
                    arrays = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(np.concatenate(lists)))
                    part = batch.slice(first, row + 1 - first)
                    columns = [part.column(0), part.column(1), pa.array(counts, pa.int64()), arrays.cast(pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, names)
                    first, counts, lists, held = row + 1, [], [], 0

    return run


def _template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """A row for each gram of each template, and one with hash 0, which every document has once."""
    known, rows = _Codes(), [(0, -1, 0, 0, 0, 0, 0, "")]
    for number, template in enumerate(templates):
        words, size = template.words, template.gram
        if not words:
            raise ValueError(f"template {number} has no words")
        need = len(words) if template.exact else -(-template.percent * len(words) // 100)
        for at, code in enumerate(gram_hashes(_coded([w.encode() for w in words], known), size).tolist()):
            rows.append((code, number, at, size, len(words), need, template.width, " ".join(words[at : at + size])))
    return spark.createDataFrame(rows, "hash long, template int, t_at int, k int, size int, need int, width int, gram string")


def _covered(hits: Column, k: Column) -> Column:
    """Words of the template that some gram of the hits covers."""
    return F.size(F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["t_at"], h["t_at"] + k - 1)))))


def _overlapping_better(spans: Column, s: Column) -> Column:
    def beats(t: Column) -> Column:
        rank = lambda c: F.struct(c["covered"], -c["template"], -c["bucket"])
        return ~t["exact"] & (t["from"] < s["until"]) & (s["from"] < t["until"]) & (rank(t) > rank(s))

    return F.exists(spans, beats)


def find_licenses(
    docs: DataFrame, templates: Sequence[Template] = (*PHRASES, *NOTICES), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``key``, ``n_words`` and ``matches``, (template, exact, from, until, covered, share) by
    ``from`` and template, with word numbers from 0 and exclusive ends.

    All rolling word grams of all texts, as 64-bit hashes, are joined with those of the templates
    (some thousand rows, broadcast if they are at most ``common.BROADCAST_ROWS``). Hits of a text and template gather by
    diagonal; diagonals within a template's ``width`` are merged in cells that overlap by half, so
    no chain of hits makes an endless span. A cell whose grams cover enough of the template is a
    proposal. Proposals are verified word by word in the texts they lie in, and counted again. Of
    overlapping spans of templates that are not exact, the one that covers most words stays (ties:
    the earlier template, then the earlier cell).

    Equal texts are searched as one: votes carry the text's digest, are made distinct where they
    arise, and the matches meet all rows of the text in ``SALTS`` parts. Only digests of proposals
    are broadcast, up to ``ID_ROWS``, and only texts with proposals are read again. Null texts are
    empty; texts without words have no matches; long texts are whole. Repeated rows and ids, and
    null ids, give a row each. Other columns are left out, so their names cannot clash.
    """
    spark = docs.sparkSession
    sizes = sorted({t.gram for t in templates})
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.md5(body).alias("digest"), F.col(key).alias("key"), body.alias("body"))
    kind = rows.schema["key"].dataType.simpleString()
    scanned = rows.mapInArrow(_grams(sizes), f"digest string, key {kind}, n_words long, grams array<long>")
    grams = _template_grams(spark, templates)
    # The grams of each size follow each other, after the one that marks the row.
    before = F.lit(1).cast("long")
    place = F.lit(None).cast("long")
    for size in sizes:
        place = F.when(F.col("k") == size, F.col("spot") - before).otherwise(place)
        before = before + F.greatest(F.lit(0), F.col("n_words") - (size - 1))
    met = scanned.select("digest", "key", "n_words", F.posexplode("grams").alias("spot", "hash")).join(small(grams), "hash")
    found = save(
        met.select("digest", F.when(F.col("template") < 0, F.col("key")).alias("key"), "n_words", "template", place.alias("at"), "t_at", "k", "size", "need", "width", "gram"),
        "license-hits",
    )

    hits = found.where("template >= 0").select("digest", "template", "at", "t_at", "k", "size", "need", "width", "gram").distinct()
    diagonal = F.col("at") - F.col("t_at")
    cell = F.floor(diagonal / F.greatest(F.col("width"), F.lit(1)))
    buckets = F.when(F.col("width") == 0, F.array(cell)).otherwise(F.array(cell, cell - 1))
    votes = hits.withColumn("bucket", F.explode(buckets)).groupBy("digest", "template", "k", "size", "need", "width", "bucket")
    voted = votes.agg(F.collect_list(F.struct("t_at", "at", "gram")).alias("hits")).where(_covered(F.col("hits"), F.col("k")) >= F.col("need"))
    proposal = F.struct("template", (F.col("width") == 0).alias("exact"), "bucket", "k", "size", "need", "hits")
    proposals = save(voted.groupBy("digest").agg(F.collect_list(proposal).alias("proposals")), "license-proposals")

    texts = rows.select("digest", "body").join(small(proposals.select("digest"), ID_ROWS), "digest", "left_semi").dropDuplicates(["digest"])
    split = proposals.join(texts, "digest").withColumn("words", F.regexp_extract_all(ascii_lower(F.col("body")), F.lit(WORD), F.lit(0)))

    def verified(p: Column) -> Column:
        def same(h: Column) -> Column:
            return F.array_join(F.slice("words", (h["at"] + 1).cast("int"), p["k"]), " ") == h["gram"]

        def counted(hits: Column) -> Column:
            places, covered = F.transform(hits, lambda h: h["at"]), _covered(hits, p["k"])
            return F.struct(
                p["template"], p["exact"], p["bucket"], F.array_min(places).alias("from"), (F.array_max(places) + p["k"]).alias("until"),
                covered.alias("covered"), (covered / p["size"]).alias("share"), (covered >= p["need"]).alias("enough"),
            )

        return F.transform(F.array(F.filter(p["hits"], same)), counted)[0]

    spans = split.select("digest", F.filter(F.transform("proposals", verified), lambda s: s["enough"]).alias("spans"))
    kept = F.filter("spans", lambda s: s["exact"] | ~_overlapping_better(F.col("spans"), s))
    match = lambda s: F.struct(s["from"], s["template"], s["until"], s["exact"], s["covered"], s["share"])
    matches = save(spans.select("digest", F.array_sort(F.transform(kept, match)).alias("matches")).where("size(matches) > 0"), "license-matches")

    salted = matches.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    all_rows = found.where("template < 0").select("digest", "key", "n_words", (F.monotonically_increasing_id() % SALTS).cast("int").alias("salt"))
    none = F.array().cast(matches.schema["matches"].dataType)
    joined = all_rows.join(salted, ["digest", "salt"], "left")
    return joined.select(F.col("key").alias(key), "n_words", F.coalesce("matches", none).alias("matches"))
