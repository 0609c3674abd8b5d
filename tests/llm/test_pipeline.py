"""The corpus pipeline against brute-force versions of its stages."""

import re

import corpus_pipeline
import pytest
import zstandard

from tests.llm.conftest import prose
from tests.llm.test_lm_bpe import library
from tests.llm.test_ngram_join import brute
from tests.llm.test_sharding_mixing import brute_mix
from tests.llm.test_text_operators import brute_pii, brute_quality
from vigil.llm import mixing, pii, quality

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    texts = [prose(i, 20 + 5 * i) for i in range(30)]
    texts += [texts[3], texts[3], texts[4] + " tail", "spam " * 300, "short", "", None,
              texts[6] + " mail me.now@example.com or +1 (017) 555-7713", "4111 1111 1111 1111 " + texts[7] + " other words end"]
    return [(100 - i, t, "en", None if i % 11 == 0 else "s%d" % (i % 4), len(t or "")) for i, t in enumerate(texts)]


def brute_kept(text):
    if not text or brute_quality(text)[-1]:
        return False
    data, bands = text.encode(), quality.DEFAULT_BANDS
    ratio = lambda b: len(b) / len(zstandard.ZstdCompressor(level=bands.level).compress(b))
    lo, hi = next((lo, hi) for below, lo, hi in bands.whole if len(data) < below)
    size, limits = bands.chunk_bytes, bands.chunk_limits
    starts = [*range(0, len(data) - size, size), len(data) - size] if len(data) > size else []
    marks = "".join(".X"[not limits[0] <= ratio(data[i:i + size]) <= limits[1]] for i in starts)
    pct = next(p for below, p in bands.bad_chunk_pct if len(data) < below)
    return lo <= ratio(data) <= hi and "X" * bands.bad_run not in marks and \
        ("X" not in marks or 100 * marks.count("X") < pct * len(marks))


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0], r[1] or ""))


def test_stages_equal_brute_force(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = stage(spark, spark.read.parquet(f"{tmp_path}/{name}"), str(tmp_path))
        results[name] = docs.collect()

    kept = [r for r in rows if brute_kept(r[1])]
    assert by_id(results["quality"]) == by_id(kept)
    comp = {d: c for d, _, c in brute([(r[0], r[1]) for r in kept])}
    unique = [r for r in kept if comp[r[0]] == r[0]]
    assert by_id(results["dedup"]) == by_id(unique)
    model = pii.train(spark.createDataFrame(unique, SCHEMA))
    hidden = []
    for d, t, lang, source, _ in unique:
        base, spans = pii.label_spans(t, model)
        assert base == brute_pii(t)
        text = pii.masked(t, spans)
        hidden.append((d, text, lang, source, len(text)))
    assert by_id(results["pii"]) == by_id(hidden)
    assert not any(re.search(r"@example|4111 1111|555-7713", r[1]) for r in hidden)
    assert len(results["mix"]) > 0 and {tuple(r) for r in results["mix"]} <= set(hidden)
    words = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in hidden}
    wanted = sum(w for *_, w in brute_mix(hidden))
    taken = sum(words[r["doc_id"]] for r in results["mix"])
    assert abs(taken - wanted) <= 0.35 * wanted
    copies = {r["doc_id"]: sum(q["doc_id"] == r["doc_id"] for q in results["mix"]) for r in results["mix"]}
    assert max(copies.values()) <= mixing.MAX_REPEAT
    assert by_id(results["bpe"]) == by_id((r["doc_id"], *library(r["text"])) for r in results["mix"])


def test_run_equals_the_stages(spark, tmp_path, write_table):
    rows = corpus()
    folder = write_table(spark.createDataFrame(rows, SCHEMA))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = stage(spark, spark.read.parquet(f"{tmp_path}/{name}"), folder)
    assert by_id(corpus_pipeline.run(spark, folder).collect()) == by_id(docs.collect())


def test_empty_corpus(spark, none, write_table):
    assert corpus_pipeline.run(spark, write_table(none)).count() == 0


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_the_columns(spark, tricky, tmp_path, k):
    tricky.write.parquet(f"{tmp_path}/in")
    out = corpus_pipeline.STAGES[k][1](spark, spark.read.parquet(f"{tmp_path}/in"), str(tmp_path))
    assert out.columns == tricky.columns
