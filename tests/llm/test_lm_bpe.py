"""PPM scores against a per-position model; BPE against the library."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from vigil.llm import bpe, lm


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


class Ppm:
    """Escape method C with exclusion, one symbol at a time."""

    def __init__(self, texts, order):
        self.order = order
        self.trie = [defaultdict(Counter) for _ in range(order + 1)]
        for text in texts:
            raw = self.raw(text)
            for i in range(order, len(raw)):
                for k in range(order + 1):
                    self.trie[k][raw[i - k:i]][raw[i]] += 1

    def raw(self, text):
        return bytes([lm.START]) * self.order + low(text).encode() + bytes([lm.END])

    def log(self, context, symbol):
        out, excluded = 0.0, set()
        for k in range(self.order, -1, -1):
            seen = self.trie[k].get(context[len(context) - k:])
            if seen is None:
                continue
            left = {s: n for s, n in seen.items() if s not in excluded}
            n, d = sum(left.values()), len(left)
            if symbol in left:
                return out + math.log10(left[symbol] / (n + d))
            if n + d:
                out += math.log10(d / (n + d))
            excluded |= set(seen)
        return out - math.log10(256 - len(excluded))

    def score(self, text):
        raw = self.raw(text)
        return sum(self.log(raw[i - self.order:i], raw[i]) for i in range(self.order, len(raw)))


def check_scores(got, rows, order, tested):
    train = [t for d, t, *_ in rows if not tested(d)]
    counts = Counter(w for t in train for w in re.findall(r"[^\x20\x09-\x0D]+", low(t)))
    if train:
        counts["\0end"] = len(train)
    total, distinct = sum(counts.values()), len(counts)
    model = Ppm(train, order)
    want = []
    for d, t, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", low(t)) + ["\0end"]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        want.append((d, tested(d), len(words), sum(counts[w] > 0 for w in words), total, base, model.score(t)))
    order_ = lambda t: (t[0] is None, t[0] or 0, t[2], t[-1])
    want, got = sorted(want, key=order_), sorted(map(tuple, got), key=order_)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def crc_tested(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def test_op4_equals_brute_force(spark, tricky, clashing, rows, write_table):
    for df in (tricky, clashing):
        table = spark.read.parquet(write_table(df) + "/documents.parquet")
        check_scores(lm.op4_query(table).collect(), rows, lm.ORDER, crc_tested)
        # several blocks a split
        check_scores(lm.score_documents(table, block_bytes=5_000).collect(), rows, lm.ORDER, crc_tested)


@pytest.mark.parametrize("order", [1, 2, 5])
def test_other_orders(spark, order, write_table):
    rows = [(i, t) for i, t in enumerate(["abracadabra", "abra cadabra", "", None, "éa" * 20, "zzz", "abc" * 30])]
    table = spark.read.parquet(write_table(spark.createDataFrame(rows, "doc_id bigint, text string")) + "/documents.parquet")
    check_scores(lm.score_documents(table, order=order).collect(), rows, order, crc_tested)


def test_nothing_to_learn_from(spark, write_table):
    held = [i for i in range(200) if crc_tested(i)][:3]
    df = spark.createDataFrame([(i, "ab") for i in held], "doc_id bigint, text string")
    out = lm.op4_query(spark.read.parquet(write_table(df) + "/documents.parquet")).collect()
    assert {(r["train_tokens"], r["n_known"]) for r in out} == {(0, 0)}
    assert all(math.isclose(r["score"], -3 * math.log10(256)) for r in out)


def test_probabilities_add_to_one(spark):
    """Over all 256 symbols, in seen and unseen contexts."""
    texts = ["the cat sat", "the dog sat on the mat", "a cat"]
    seen = Counter(int(g) for t in texts for g in lm.byte_strings(t.encode()))
    for context in (b"the", b"e c", b"zzz", b"\xfe\xfe\xfe", b"xat"):
        base = int.from_bytes(context, "big") << 8
        asked = {base + s for s in range(256)}
        rows = [(g, seen.get(g, 0)) for g in asked | set(seen)]
        out = lm.trie_probabilities(spark.createDataFrame(rows, "gram bigint, c bigint")).collect()
        assert math.isclose(sum(10 ** r["logp"] for r in out if r["gram"] in asked), 1.0, rel_tol=1e-9)


def test_model_beats_uniform_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = lm.op4_query(docs).where("held_out").collect()
    chars = {r["doc_id"]: len(r["text"].encode()) for r in docs.collect()}
    bits = -sum(r["score"] for r in out) * math.log2(10) / sum(chars[r["doc_id"]] + 1 for r in out)
    assert bits < 3.0


def test_op4_empty_table(spark, none, write_table):
    assert lm.op4_query(spark.read.parquet(write_table(none) + "/documents.parquet")).count() == 0


def library(text):
    tokenizer = bpe.load_tokenizer(bpe.default_tokenizer())
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


AWKWARD = ["<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>", "é ́x   y　z", "İSTANBUL ΣΊΣΥΦΟΣ",
           "don't we'll I'VE 's", "x\x00y\x1cz\x85w", "\U0001f468‍\U0001f469 ١٢٣ 123", "Ａｂ ﬁ ẞ", "ཱི 가",
           "!!!??? -- a_b", "a" * 3000]


def test_op6_equals_the_library(spark, tricky, clashing, rows, write_table):
    extra = [(500 + i, t, "en", "a", 0) for i, t in enumerate(AWKWARD)]
    more = spark.createDataFrame(extra, tricky.schema)
    want = sorted(((d, *library(t)) for d, t, *_ in rows + extra), key=lambda t: (t[0] is None, t))
    table = spark.read.parquet(write_table(tricky.unionByName(more)) + "/documents.parquet")
    for out in (bpe.op6_query(table), bpe.encode_documents(table, block_bytes=5_000, flush_words=300)):
        assert sorted(map(tuple, out.collect()), key=lambda t: (t[0] is None, t)) == want
    other = bpe.op6_query(spark.read.parquet(write_table(clashing) + "/documents.parquet")).collect()
    assert sorted(map(tuple, other), key=lambda t: (t[0] is None, t)) == [w for w in want if w[0] is None or w[0] < 500]


def test_decode_join_equals_the_library(spark, write_table):
    docs = spark.createDataFrame(list(enumerate(AWKWARD + ["", None])), "doc_id bigint, text string")
    table = spark.read.parquet(write_table(docs) + "/documents.parquet")
    encoded = bpe.encode_documents(table, with_ids=True)
    pieces = bpe.vocabulary(spark, bpe.default_tokenizer())
    joined = {r["doc_id"]: r["decoded"] for r in bpe.decode(encoded, pieces).collect()}
    tokenizer = bpe.load_tokenizer(bpe.default_tokenizer())
    for r in encoded.collect():
        assert joined[r["doc_id"]] == r["decoded"] == tokenizer.decode(r["ids"], skip_special_tokens=False)


def test_op6_empty_table(spark, none, write_table):
    assert bpe.op6_query(spark.read.parquet(write_table(none) + "/documents.parquet")).count() == 0
