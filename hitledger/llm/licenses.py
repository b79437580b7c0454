"""License notices in texts: MinHash bands over overlapping windows, then exact containment.

Words are runs of letters and digits, ASCII lower-cased, so punctuation doesn't matter. A template of
n five-word shingles belongs to the window width w, the power of two with w/2 < n <= w. Over every
text, windows of w shingles start every max(1, w/4) shingles; the last one ends with the text. Window
and template share a band if one of ``BANDS`` minimum hashes is equal; a band is one row, so a pair
of Jaccard similarity j meets in some band with probability 1 - (1 - j) ** BANDS. A whole notice has
a window with j >= 1/3: 0.999997; one with four fifths of its shingles, in one place, still has
j >= 0.24: 0.9998. Equal minima mean a shared shingle, so few windows are retrieved in vain.

Retrieved templates are verified with whole shingle keys: the share of the template's shingles found
within its own length, plus a quarter, of some place near the window must be ``LEAST`` or more.

Templates are a parameter, broadcast with the code; their number is a property of the library, not of
the data. The library holds usual notices and whole licence texts (``license_texts``); notices
that share most of their words, as those of GPL and AGPL do, are both found, the closer one with the
higher containment. Rows too short for a template leave before its windows are made. Each text is read whole, in the task that holds it; there is no shuffle.

Defined results: null and empty texts, and texts of fewer than five words, match nothing (shorter
templates are refused); repeated rows give equal matches each; of several places, the one with the
highest containment counts, the first among equals; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hitledger.llm import textkeys as tk
from hitledger.llm.common import text_or_empty

SHINGLE, BANDS, LEAST = 5, 32, 0.8
#: Bits of the table that tells whether a minimum can be a template's.
SIEVE = 16

# Notices by which texts state their licence.
_SHORT = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "MIT": "Released under the MIT License.",
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def _library() -> dict[str, str]:
    """The short notices above, those of ``notices.tsv`` and the whole texts beside it, by name."""
    folder = resources.files(__package__) / "license_texts"
    rows = (folder / "notices.tsv").read_text("utf-8").splitlines()
    notices = dict(row.split("\t", 1) for row in rows)
    texts = {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in folder.iterdir() if f.name.endswith(".txt")}
    return {**_SHORT, **notices, **dict(sorted(texts.items()))}


NOTICES = _library()


def hash_seeds(bands: int = BANDS) -> np.ndarray:
    return tk.mixed(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def band_hashes(keys: np.ndarray, seed: np.uint64) -> np.ndarray:
    """One hash function's 32-bit values of shingle keys (multiply and shift, odd multiplier)."""
    return ((keys * (seed | np.uint64(1))) >> np.uint64(32)).astype(np.uint32)


class Templates:
    """The templates' shingles, and for each window width the minima that retrieve them."""

    def __init__(self, texts: Mapping[str, str]):
        self.names = list(texts)
        found = tk.words(pa.array(list(texts.values()), pa.string()), tk.ALPHANUMERIC)
        offsets, keys = tk.shingles(found, SHINGLE)
        short = [n for n, count in zip(self.names, np.diff(found.offsets)) if count < SHINGLE]
        if short:
            raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
        self.shingles = [np.unique(keys[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        self.words = np.diff(found.offsets)
        self.widths = [1 << int(len(s) - 1).bit_length() for s in self.shingles]
        self.seeds = hash_seeds()
        self.minima: dict[int, list[dict[int, list[int]]]] = {}
        self.sieves: dict[int, np.ndarray] = {}
        for t, (width, own) in enumerate(zip(self.widths, self.shingles)):
            tables = self.minima.setdefault(width, [{} for _ in self.seeds])
            sieve = self.sieves.setdefault(width, np.zeros((len(self.seeds), 1 << SIEVE), bool))
            for b, seed in enumerate(self.seeds):
                least = int(band_hashes(own, seed).min())
                tables[b].setdefault(least, []).append(t)
                sieve[b, least & (1 << SIEVE) - 1] = True

    def retrieve(self, offsets: np.ndarray, keys: np.ndarray) -> set[tuple[int, int, int]]:
        """(row, first shingle of the window, template) of all windows that share a band."""
        found: set[tuple[int, int, int]] = set()
        levels = self._levels(offsets)
        for b, seed in enumerate(self.seeds):
            least, width = band_hashes(keys, seed), 1
            for rows, own, taken, inside in levels:
                if taken is not None:
                    least = least[taken]
                if width in self.minima:
                    sieve, table = self.sieves[width][b], self.minima[width][b]
                    for at in np.flatnonzero(sieve[least & np.uint32((1 << SIEVE) - 1)]).tolist():
                        for t in table.get(int(least[at]), ()):
                            row = int(np.searchsorted(own, at, "right")) - 1
                            place, last = at - int(own[row]), max(0, int(own[row + 1] - own[row]) - width)
                            if place == last or place < last and place % max(1, width // 4) == 0:
                                found.add((int(rows[row]), place, t))
                if inside is None:
                    break
                # windows end with their row: the other half counts where it begins before that
                wider = least.copy()
                np.minimum(least[:-width], least[width:], out=wider[:-width], where=inside)
                least, width = wider, 2 * width
        return found

    def _levels(self, offsets: np.ndarray) -> list[tuple]:
        """For widths 1, 2, 4 and so on: (rows, their offsets, shingles taken from the level before or
        None, where the next width has a second half or None at the end).

        A row with fewer than two fifths of a width's shingles has less than four fifths of any
        template of that width or beyond, and leaves.
        """
        rows, levels, width, most = np.arange(len(offsets) - 1), [], 1, max(self.minima)
        while True:
            counts, taken = np.diff(offsets), None
            stays = 5 * counts >= 2 * width
            if not stays.all():
                taken = np.flatnonzero(np.repeat(stays, counts))
                rows, counts = rows[stays], counts[stays]
                offsets = np.concatenate([[0], np.cumsum(counts)])
            if width >= most or not len(rows):
                levels.append((rows, offsets, taken, None))
                return levels
            left = np.repeat(offsets[1:], counts) - np.arange(offsets[-1])
            levels.append((rows, offsets, taken, left[:-width] > width))
            width *= 2

    def verify(self, own: np.ndarray, place: int, t: int) -> tuple[float, int, int] | None:
        """(containment, first word, word behind) of template t near a window of one row."""
        wanted, reach = self.shingles[t], len(self.shingles[t]) + len(self.shingles[t]) // 4
        low = max(0, place - self.widths[t])
        part = own[low : place + 3 * self.widths[t]]
        at = np.minimum(np.searchsorted(wanted, part), len(wanted) - 1)
        hits = np.flatnonzero(wanted[at] == part)
        best = None
        for k, first in enumerate(hits):
            inside = hits[k : np.searchsorted(hits, first + reach)]
            share = len(np.unique(at[inside])) / len(wanted)
            if share >= LEAST and (best is None or share > best[0]):
                best = (share, low + int(first), low + int(inside[-1]) + SHINGLE)
        return best


FOUND = "license string, containment double, first_word long, end_word long"


def _scanned(texts: Mapping[str, str], text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(texts)
        for whole in batches:
            for start, stop in tk.slices(whole.column(text_at), 4 << 20):
                part = whole.slice(start, stop - start)
                words = tk.words(part.column(text_at), tk.ALPHANUMERIC)
                offsets, keys = tk.shingles(words, SHINGLE)
                best: dict[tuple[int, int], tuple[float, int, int]] = {}
                for row, place, t in sorted(templates.retrieve(offsets, keys)):
                    if words.offsets[row + 1] - words.offsets[row] < SHINGLE:
                        continue
                    match = templates.verify(keys[offsets[row] : offsets[row + 1]], place, t)
                    if match and (row, t) not in best or match and match[0] > best[row, t][0]:
                        best[row, t] = match
                chosen = sorted(best)
                kept = part.take(pa.array([row for row, _ in chosen], pa.int64()))
                columns = [c for k, c in enumerate(kept.columns) if k != text_at]
                matches = [best[x] for x in chosen]
                columns += [
                    pa.array([templates.names[t] for _, t in chosen], pa.string()),
                    pa.array([m[0] for m in matches], pa.float64()),
                    pa.array([m[1] for m in matches], pa.int64()),
                    pa.array([m[2] for m in matches], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def scan_licenses(docs: DataFrame, notices: Mapping[str, str] = NOTICES, *, text: str = "text") -> DataFrame:
    """One row per document and licence found: all other columns, licence, containment, word span."""
    names = [f.split(" ")[0] for f in FOUND.split(", ")]
    kept = docs.drop(text, *names)
    fields = T.StructType([*kept.schema.fields, *T._parse_datatype_string(FOUND).fields])
    given = docs.select(*kept.columns, text_or_empty(text).alias("__text"))
    return given.mapInArrow(_scanned(dict(notices), len(kept.columns), fields.names), fields)


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs)


_WORDS = "[0-9a-z\\x{80}-\\x{10FFFF}]+"
_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words_of(text: str) -> str:
    return f"regexp_extract_all({_LOWER.format(text)}, '{_WORDS}') as w"


_SHINGLES = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))"


def _values() -> str:
    quoted = (f"('{n}', '{t.replace(chr(39), chr(39) * 2)}')" for n, t in NOTICES.items())
    return ", ".join(quoted)


#: Every place of every text, without windows or bands.
OP4_SQL = f"""
with notices(license, notice) as (values {_values()}),
wanted as (
  select license, unnest(own) as shingle, len(own) as n, len(own) + len(own) // 4 as reach
  from (select license, list_distinct({_SHINGLES}) as own from (select license, {_words_of("notice")} from notices))),
docs as (select row_number() over () as r, doc_id, {_words_of("text")} from documents),
places as (
  select r, doc_id, unnest(own) as shingle, unnest(range(len(own))) as i
  from (select r, doc_id, {_SHINGLES} as own from docs)),
hits as (select r, doc_id, i, license, shingle, n, reach from places join wanted using (shingle)),
spans as (
  select a.r, a.doc_id, a.license, a.i as first_word, max(b.i) + {SHINGLE} as end_word,
    count(distinct b.shingle) / any_value(a.n) as containment
  from hits a join hits b on a.r = b.r and a.license = b.license and b.i >= a.i and b.i < a.i + a.reach
  group by all),
ranked as (
  select *, row_number() over (partition by r, license order by containment desc, first_word) as place
  from spans where containment >= {LEAST})
select doc_id, license, cast(containment as double) as containment,
  cast(first_word as bigint) as first_word, cast(end_word as bigint) as end_word
from ranked where place = 1
"""
