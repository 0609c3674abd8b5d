"""License scan: an exact set-similarity join of text blocks with notice templates.

Blocks are all windows of ``BLOCK`` words (more where a template needs them), so a passage matches wherever it starts.
A block matches a template T when it holds at least ``need = ceil(9/10 |T|)`` of T's
distinct words. A window that starts between template words holds no more of them
than the one that starts at the next, so only those are looked at; windows of one
document with the same template words are one block, at its first place.

1. Every word of the templates is counted over all documents; the counts give
   the global order, rarest first.
2. *Prefix filter.* A block that holds ``need`` words of T holds one of T's
   ``|T| - need + 1`` rarest. Only blocks with such a word, and with as many
   template words as the least ``need``, leave the scan, each as its template
   words in global order.
3. *Length and positional filters* on the join of block words with template
   prefixes: the words left after the shared one must still reach ``need``.
4. What remains is counted exactly.

The templates are a fixed short list, so their side of the join is broadcast;
blocks of one document or of many copies are rows like any other, so nothing
gathers in one task. Null texts are empty. Repeated ids are told apart by their
text.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import byte_list, map_batches, shared_table
from vigil.session import cut_lineage

# Fixed values of the contract: phrase -> label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Public license notices, as words.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
)
NUM, DEN = 9, 10               # containment: short notices differ from each other by one word
BLOCK, STEP = 32, 1
_LOWER_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return text.translate(_LOWER_WORDS).split()


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase stands."""
    line = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases.items():
        key = b" " + phrase.encode() + b" "
        at, word, counted = line.find(key), 0, 0
        while at >= 0:
            word, counted = word + line.count(b" ", counted, at), at
            found.append((word, label))
            at = line.find(key, at + 1)
    return sorted(found)


def template_table(templates=TEMPLATES) -> list[tuple[int, str, list[str]]]:
    return [(i, label, sorted(set(text.split()))) for i, (label, text) in enumerate(templates)]


def block_words(templates) -> int:
    """Words of a block: room for the longest template with a quarter more."""
    return max([BLOCK, *(5 * len(text.split()) // 4 for _, text in templates)])


def word_counts(docs: DataFrame, vocabulary: set[bytes]) -> DataFrame:
    """(word, n) of the vocabulary over all documents."""
    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter = Counter()
        for text in byte_list(batch.column(0)):
            words = Counter(words_of(text))
            for w in vocabulary.intersection(words):
                counts[w] += words[w]
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"])
    return map_batches(docs, fn, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def prefix_size(size: int) -> int:
    return size - (NUM * size + DEN - 1) // DEN + 1


def blocks_of(words: list[bytes], order: dict[bytes, int], firsts: set[bytes], least: int,
              width: int = BLOCK) -> list[dict]:
    """The blocks that hold a word of ``firsts`` and ``least`` words of ``order``."""
    held = [i for i, w in enumerate(words) if w in order]
    rare = [i for i in held if words[i] in firsts]
    found: dict[tuple[int, ...], int] = {}
    k = 0
    for at, start in enumerate(held):
        while k < len(rare) and rare[k] < start:
            k += 1
        if k == len(rare):
            break
        if rare[k] - start < width:
            inside = {order[words[i]] for i in held[at:at + width] if i < start + width}
            if len(inside) >= least:
                found.setdefault(tuple(sorted(inside)), start)
    return [{"start": start, "words": list(inside)} for inside, start in found.items()]


def scan(docs: DataFrame, templates, rank: dict[str, int], phrases: dict[str, str], width: int = BLOCK) -> DataFrame:
    """One row per document: base columns, and the blocks that hold a prefix
    word of a template, as ranks of their template words in rising order."""
    order = {w.encode(): r for w, r in rank.items()}
    firsts = {w.encode() for _, _, ws in templates
              for w in sorted(ws, key=rank.__getitem__)[:prefix_size(len(ws))]}
    least = min((len(ws) - prefix_size(len(ws)) + 1 for _, _, ws in templates), default=1)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, text_hash bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
              "base_labels array<string>, blocks array<struct<start: bigint, words: array<int>>>")
    block_type = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.list_(pa.int32()))]))

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in byte_list(batch.column(1)):
            words = words_of(text)
            distinct = set(words)
            places = phrase_places(words, phrases) if any(
                distinct.issuperset(p.encode().split()) for p in phrases) else []
            blocks = blocks_of(words, order, firsts, least, width) if not firsts.isdisjoint(distinct) else []
            rows.append((xxhash.xxh3_64_intdigest(text) - 2**63, len(words), len(places),
                         places[0][0] if places else None, places[-1][0] if places else None,
                         sorted({label for _, label in places}), blocks))
        types = [pa.int64()] * 5 + [pa.list_(pa.string()), block_type]
        names = ["text_hash", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], ["doc_id", *names])

    return map_batches(docs, fn, schema)


def matches(spark: SparkSession, scanned: DataFrame, templates, rank: dict[str, int]) -> DataFrame:
    """(doc_id, text_hash, start, label, containment) of every matching block."""
    rows = [(i, label, sorted(rank[w] for w in ws), len(ws), len(ws) - prefix_size(len(ws)) + 1)
            for i, label, ws in templates]
    # A fixed list of notices: its size does not depend on the data.
    table = spark.createDataFrame(rows, "template int, label string, ranks array<int>, size int, need int")
    prefixes = table.select("*", F.posexplode(F.slice("ranks", F.lit(1), F.col("size") - F.col("need") + 1)).alias("t_pos", "word"))
    blocks = scanned.select("doc_id", "text_hash", F.explode("blocks").alias("block")).select(
        "doc_id", "text_hash", "block.start", "block.words", F.size("block.words").alias("b_size"))
    tokens = blocks.select("*", F.posexplode("words").alias("b_pos", "word"))
    left = F.least(F.col("size") - F.col("t_pos"), F.col("b_size") - F.col("b_pos"))
    pairs = tokens.join(F.broadcast(prefixes), "word").where(
        (F.col("b_size") >= F.col("need")) & (left + F.least("t_pos", "b_pos") >= F.col("need")))
    both = F.size(F.array_intersect("words", "ranks"))
    return pairs.where(both >= F.col("need")).select(
        "doc_id", "text_hash", "start", "label", (both / F.col("size")).alias("containment")).distinct()


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
                 phrases: dict[str, str] = PHRASES) -> tuple[DataFrame, DataFrame]:
    """(one row per document with its base places, matching blocks)."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    table = template_table(templates)
    vocabulary = {w.encode() for _, _, ws in table for w in ws}
    # At most one row per word of the fixed templates reaches the driver.
    counts = {r["word"]: r["n"] for r in word_counts(source.select("text"), vocabulary).collect()}
    ordered = sorted((w.decode() for w in vocabulary), key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(ordered)}
    scanned = shared_table(scan(source, table, rank, phrases, block_words(templates)), "license-scan")
    return scanned, matches(spark, scanned, table, rank)


def op9_query(docs: DataFrame) -> DataFrame:
    scanned, found = license_scan(docs)
    per_doc = cut_lineage(found.groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best"),
        F.count(F.lit(1)).alias("n_blocks")))
    j = scanned.drop("blocks").alias("s").join(
        per_doc.alias("f"), F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")) & (
            F.col("s.text_hash") == F.col("f.text_hash")), "left")
    labels = F.array_sort(F.array_union("s.base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    return j.select(
        "s.doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("s.base_labels"), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)),
                   F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)).alias("score"))
