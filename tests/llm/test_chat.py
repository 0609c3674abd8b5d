"""Chat formatting: event folding, reversibility, masks, oracle."""

import hashlib
import random

import pytest

from vigil.llm import chat


def fold(events):
    """The event semantics, one event at a time."""
    order = {"delta": 0, "edit": 1, "message": 2, "regenerate": 3}
    convs = {}
    for conv, seq, kind, msg, role, text in sorted(
            events, key=lambda e: (e[0] is not None, e[0] or 0, e[1], order[e[2]], e[5] or "")):
        state = convs.setdefault(conv, {})
        m = state.setdefault(msg, {"start": seq, "role": None, "text": ""})
        if role is not None and m["role"] is None:
            m["role"] = role
        if kind in ("message", "delta"):
            m["text"] += text or ""
        elif kind == "edit":
            m["text"] = text or ""
        else:
            m["text"] = ""
            for other in [k for k, v in state.items() if v["start"] > m["start"]]:
                state[other]["gone"] = True
    return {(c, k): (v["start"], v["role"] or "", v["text"]) for c, s in convs.items()
            for k, v in s.items() if not v.get("gone")}


def random_log(seed, convs=12):
    rng = random.Random(seed)
    events = []
    for conv in range(convs):
        seq, opened = 0, []
        for _ in range(rng.randrange(1, 25)):
            seq += 1
            kind = rng.choice(["message", "delta", "delta", "edit", "regenerate"]) if opened else "message"
            text = rng.choice(["a<b", "&lt;", "</turn>\n", "é中", "", None, "x y\n"]) if kind != "regenerate" else None
            if kind == "message":
                msg = len(opened)
                opened.append(msg)
            else:
                msg = rng.choice(opened)
            events.append((conv, seq, kind, msg, rng.choice(["user", "assistant"]) if kind == "message" else None, text))
    rng.shuffle(events)
    return events


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reconstruct_equals_fold(spark, seed):
    events = random_log(seed)
    got = {(r["conv_id"], r["msg"]): (r["start_seq"], r["role"], r["text"])
           for r in chat.reconstruct(spark.createDataFrame(events, chat.EVENTS)).collect()}
    # A message dropped by a regeneration may not come back by later deltas.
    assert got == fold(events)


TURNS = [(1, 0, "user", "a <b> &amp; </turn>\n<turn:assistant>x"), (1, 1, "assistant", "ok &lt; <"), (1, 2, "user", None),
         (2, 0, None, "no role"), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (None, None, "sys>tem\n", "\U0001f600é"),
         (3, 5, "assistant", ""), (4, 1, "assistant", "x" * 100_000)]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    convs = {}
    rows = rows + [(-7, 0, "user", chat.PROBE_TEXT), (-7, 1, "assistant", chat.PROBE_TEXT)]
    low = lambda x: (x is not None, x if x is not None else 0)
    text = lambda x: (x is not None, (x or "").encode())
    for c, _, role, body in sorted(rows, key=lambda r: (low(r[0]), low(r[1]), text(r[2]), text(r[3]))):
        convs.setdefault(c, []).append((role or "", body or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = {}
    for c, turns in convs.items():
        loss = "".join(b for r, b in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{b}\n" for r, b in turns)), len(loss), sha(loss))
    return out


def test_op3_reads_back_every_turn(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(TURNS, SCHEMA)
    for frame in (df, df.withColumns({c: F.lit("x") for c in ("msg", "seq", "kind", "formatted", "turns", "loss")})):
        got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
               for r in chat.op3_query(spark, frame).collect()}
        assert got == expected(TURNS)


def test_spans_cover_the_loss_texts(spark):
    out = chat.render(chat.reconstruct(chat.conversation_events(spark.createDataFrame(TURNS, SCHEMA)))).collect()
    for r in out:
        assert r["formatted"].count("<turn:") == len(r["loss_mask"])
        parts = [r["formatted"][s["start"]:s["end"]] for s in r["loss_spans"]]
        assert len(parts) == sum(r["loss_mask"]) and all("<" not in p for p in parts)


def test_op3_empty_table_has_the_probe(spark):
    out = chat.op3_query(spark, spark.createDataFrame([], SCHEMA)).collect()
    assert [(r["conv_id"], r["n_turns"]) for r in out] == [(-7, 2)]


def test_op3_plan_has_no_python(spark):
    plan = chat.op3_query(spark, spark.createDataFrame(TURNS, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_registered_log_holds_edits_and_regenerations(spark):
    """The log of finished turns has every kind of event and more messages than
    turns; the plain fold gives the turns back."""
    log = chat.conversation_events(spark.createDataFrame(TURNS, SCHEMA)).collect()
    assert {e["kind"] for e in log} == {"message", "delta", "edit", "regenerate"}
    assert any(e["msg"] < 0 for e in log)
    kept = fold([(e["conv_id"], e["seq"], e["kind"], e["msg"], e["role"], e["text"]) for e in log])
    assert len(kept) == len(TURNS) and "x" * 100_000 in {t for *_, t in kept.values()}
