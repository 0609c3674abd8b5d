"""Cross-tokenizer alignment against a plain reading of the definition."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import prose
from vigil.llm import alignment


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(alignment.byte_bpe())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.piece_bpe())


def spans(pieces):
    at, out = 0, []
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(texts, tokenizers):
    """(groups text, linked pairs) of each text; pairs as a list of occurrences."""
    a_tok, b_tok = tokenizers
    from tokenizers.decoders import ByteLevel
    found = []
    for text in texts:
        want = b" " + (text or "").encode()
        if not text:
            found.append(("", [], 0, 0))
            continue
        enc = a_tok.encode(" " + text, add_special_tokens=False)
        # Offsets are in characters, so bytes come from the alphabet of single-byte tokens.
        table = {c: b for c, b in alignment._byte_of_char().items()}
        assert ByteLevel().decode(enc.tokens) == " " + text
        ap = [bytes(table[c] for c in t) for t in enc.tokens]
        ids = b_tok.encode(text)
        bp = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") and b_tok.is_byte(i)
              else p.replace("▁", " ").encode() for i in ids for p in [b_tok.id_to_piece(i)]]
        if b"".join(ap) != want or b"".join(bp) != want:
            found.append(("", [], 0, 0))
            continue
        sa, sb = spans(ap), spans(bp)
        cuts = {e for _, e in sa} & {e for _, e in sb}
        groups, links = [], []
        for cut in sorted(cuts):
            lo = max([c for c in cuts if c < cut], default=0)
            groups.append(",".join(str(i) for i, (s, e) in zip(enc.ids, sa) if lo <= s and e <= cut) + "|" +
                          ",".join(str(i) for i, (s, e) in zip(ids, sb) if lo <= s and e <= cut))
        for i, (s, e) in zip(enc.ids, sa):
            links += [(i, j) for j, (p, q) in zip(ids, sb) if p < e and s < q]
        found.append((";".join(groups), links, len(enc.ids), len(ids)))
    return found


def brute_rows(rows, tokenizers):
    aligned = brute([t for _, t in rows], tokenizers)
    count = Counter(p for _, links, _, _ in aligned for p in set(links))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(d, n_a, n_b, groups.count(";") + 1 if groups else 0, len(links), sum(count[p] == best[p[0]] for p in links),
             sum(count[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
            for (d, _), (groups, links, n_a, n_b) in zip(rows, aligned)], count, best


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, str(r)))


TEXTS = ["Hello  world", " lead", "tail ", "a\tb\nc\r\n", "<|endoftext|> </s> <s> <unk> <0x41>", "▁under", "日本語 \U0001f600 é é",
         "don't   stop", "x" * 500, "\x00nul", " nbsp 　wide", "ﬁ ligature"]


def corpus():
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    return rows + [(100 + i, prose(i % 9, 15 + i, 60).capitalize() + ".") for i in range(40)] + [(7, None), (8, ""), (None, "no id")]


@pytest.mark.parametrize("block_bytes,radixes,fan_in", [(alignment.BLOCK_BYTES, 64, 64), (300, 3, 2)])
def test_documents_and_pair_table_equal_brute_force(spark, tokenizers, block_bytes, radixes, fan_in):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).checkpoint()
    made = alignment.Alignment(df, block_bytes=block_bytes, radixes=radixes, fan_in=fan_in)
    want, count, best = brute_rows(rows, tokenizers)
    assert by_id(made.documents().collect()) == by_id(want)
    assert sorted(map(tuple, made.pair_table().collect())) == sorted(
        (a, b, n, n == best[a]) for (a, b), n in count.items())


def test_cutting_at_spaces_changes_no_id(tokenizers):
    """Whole texts and remembered stretches have the same ids, whatever stands
    around the spaces."""
    import random
    rng = random.Random(3)
    parts = ["a", "The", "don't", "'s", "9", "12.5", "x_y", "é", "中文", "\u0301", "\u3000", "\u00a0", "\u2581", "\n", "\t", "\r\n",
             "\x1c", "\x85", "\u200b", "!", "<|endoftext|>", "</s>", "\U0001f600", "_", "²", "ⅷ", ""]
    texts = [" ".join(rng.choices(parts, k=rng.randrange(1, 12))) + rng.choice(["", " ", "  "]) for _ in range(3000)]
    texts += ["".join(rng.choices(parts + [" ", "  ", "   "], k=rng.randrange(1, 16))) for _ in range(3000)]
    both = alignment.Sides(alignment.byte_bpe(), alignment.piece_bpe())
    assert both._cuts
    a, b = both.encode([t.encode() for t in texts])
    for i, t in enumerate(texts):
        if a.counts[i]:
            assert a.of(i).tolist() == tokenizers[0].encode(" " + t, add_special_tokens=False).ids, repr(t)
            assert b.of(i).tolist() == tokenizers[1].encode(t), repr(t)
        else:
            ids = tokenizers[1].encode(t)
            assert not t or b"".join(both.b_bytes[j] for j in ids) != b" " + t.encode(), repr(t)


def test_groups_are_written_out(spark, tokenizers):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k bigint, body string")
    got = {r["k"]: r["groups"] for r in alignment.token_groups(df, "k", "body").collect()}
    assert [got[i] for i in range(len(TEXTS))] == [g for g, *_ in brute(TEXTS, tokenizers)]


def test_merge_sums_runs_of_many_frames(monkeypatch):
    monkeypatch.setattr(alignment, "FRAME", 5)
    rng, io, want, runs = np.random.default_rng(2), alignment.Runs(), Counter(), []
    for _ in range(9):
        keys = np.unique(rng.integers(0, 120, rng.integers(0, 60)))
        counts = rng.integers(1, 9, len(keys))
        want.update(dict(zip(keys.tolist(), counts.tolist())))
        runs.append(io.write(keys.astype("<i8"), counts.astype("<i8")) if len(keys) else [])
    merged = list(io.merge(runs))
    keys = np.concatenate([k for k, _ in merged])
    assert (np.diff(keys) > 0).all()
    assert dict(zip(keys.tolist(), np.concatenate([c for _, c in merged]).tolist())) == dict(want)


def test_op11_on_tricky_rows(tricky, clashing, rows, tokenizers):
    short = [(d, t) for d, t, *_ in rows if len(t or "") < 5000]
    want = by_id(brute_rows(short, tokenizers)[0])
    for df in (tricky, clashing):
        got = alignment.op11_query(df.where("text is null or length(text) < 5000"))
        assert by_id(got.collect()) == want
    assert alignment.op11_query(tricky).count() == len(rows)


def test_op11_empty_table(none):
    assert alignment.op11_query(none).count() == 0


def test_a_fan_in_of_one_is_refused(none):
    with pytest.raises(ValueError):
        alignment.Alignment(none, fan_in=1)
