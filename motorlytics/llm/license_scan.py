"""License scans: exact phrases and fuzzy search for short notices.

A notice with at most k edits, split into k + 1 pieces, keeps one piece unchanged (pigeonhole). So every approximate
occurrence has one of the pieces at a known offset; the pieces are searched exactly, and around each hit the bounded-error
matching of the regex library decides and gives span and number of edits. Text is compared as lower-case words joined by
single spaces, so layout and punctuation don't count as edits.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlytics.llm.common import batch, table

# The phrases of the base scan and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices that are searched with errors, and their labels. One edit is allowed per EDIT_EVERY characters.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache",
    "licensed under the gnu general public license": "gpl",
    "free software you can redistribute it and or modify it under the terms of the gnu": "gpl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "licensed under cc by": "cc",
    "licensed under a creative commons attribution": "cc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
EDIT_EVERY = 12

_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
MATCH = "array<struct<label:string,notice:string,first_word:long,start:long,end:long,edits:int>>"


def normal(text: str) -> bytes:
    """The text's words, A-Z lower-cased, joined by single spaces, as UTF-8."""
    return b" ".join(text.encode().translate(_FOLD).split())


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of nearly equal length with their offsets; together they are the whole notice."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@functools.lru_cache(maxsize=8)
def compiled(notices: tuple[tuple[str, str], ...], edit_every: int) -> list:
    made = []
    for notice, label in notices:
        edits = len(notice) // edit_every
        pattern = regex.compile(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}")
        seeds = [(offset, seed, seed.encode()) for offset, seed in pieces(notice, edits)]
        made.append((notice, label, edits, pattern, seeds))
    return made


def fuzzy(words: str, raw: bytes, searches: list) -> list[tuple[str, str, int, int, int]]:
    """(label, notice, start, end, edits) of every notice found in ``words``; spans of one notice don't overlap."""
    found = []
    for notice, label, edits, pattern, seeds in searches:
        at = set()
        for offset, seed, seed_raw in seeds:
            if seed_raw in raw:
                p = words.find(seed)
                while p >= 0:
                    at.add(p - offset)
                    p = words.find(seed, p + 1)
        done = 0
        for start in sorted(at):
            low, high = max(done, start - edits), start + len(notice) + edits
            if high > low and (m := pattern.search(words, low, high)):
                found.append((label, notice, m.start(), m.end(), sum(m.fuzzy_counts)))
                done = m.end()
    return found


def exact(raw: bytes, phrases: dict[str, str]) -> list[tuple[str, str, int]]:
    """(label, phrase, first word) of every place where a phrase's words stand in a row; places may share words."""
    padded, found = b" " + raw + b" ", []
    for phrase, label in phrases.items():
        needle = b" " + phrase.encode() + b" "
        word = before = 0
        p = padded.find(needle)
        while p >= 0:
            word, before = word + raw.count(b" ", before, p), p
            found.append((label, phrase, word))
            p = padded.find(needle, p + 1)
    return found


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES,
                 notices: dict[str, str] = NOTICES, edit_every: int = EDIT_EVERY) -> DataFrame:
    """``doc_id``, ``n_words``, ``places`` (exact phrases) and ``matches`` (notices with errors), one row per input row.

    ``start`` and ``end`` are code points of the original text, ``first_word`` counts from 0. Null or empty text: no
    words, empty lists. Null ids and repeated rows stay; other columns are not read; an empty table gives no rows.
    """
    searches = compiled(tuple(notices.items()), edit_every)
    place = pa.struct([("label", pa.string()), ("phrase", pa.string()), ("first_word", pa.int64())])
    match = pa.struct([("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()),
                       ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(place)),
                        ("matches", pa.list_(match))])

    def spans(text: str, found: list) -> list[dict]:
        """Places in the joined words turned into places in the text."""
        marks = [m.span() for m in _WORD.finditer(text)]
        starts, at = [], 0
        for a, b in marks:
            starts.append(at)
            at += b - a + 1
        out = []
        for label, notice, start, end, edits in found:
            first = bisect.bisect_right(starts, start) - 1
            last = bisect.bisect_right(starts, max(end - 1, start)) - 1
            begin = marks[first][0] + min(start - starts[first], marks[first][1] - marks[first][0])
            finish = marks[last][0] + min(end - starts[last], marks[last][1] - marks[last][0])
            out.append({"label": label, "notice": notice, "first_word": first, "start": begin, "end": finish,
                        "edits": edits})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            counts, places, matches = [], [], []
            for text in rows.column(1).to_pylist():
                raw = normal(text or "")
                counts.append(raw.count(b" ") + 1 if raw else 0)
                places.append([{"label": a, "phrase": b, "first_word": c} for a, b, c in exact(raw, phrases)])
                words = raw.decode() if any(s[2] in raw for x in searches for s in x[4]) else ""
                found = fuzzy(words, raw, searches) if words else []
                matches.append(spans(text, found) if found else [])
            yield batch(schema, [rows.column(0), counts, places, matches])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kinds = f"doc_id long, n_words long, places array<struct<label:string,phrase:string,first_word:long>>, matches {MATCH}"
    return source.mapInArrow(run, kinds)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan(table(spark, sf_dir, "documents"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base, more = F.col("places.label"), F.col("matches.label")
    alike = F.transform("matches", lambda m: 1 - m["edits"] / F.length(m["notice"]))
    return rows.select(
        "doc_id", "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.first_word").alias("first_word"),
        F.array_max("places.first_word").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, more)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(alike), F.lit(0.0))).cast("double").alias("score"),
        F.size("matches").cast("long").alias("n_fuzzy"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m["label"], m["start"], m["end"], m["edits"])), ",").alias("spans"),
    )
