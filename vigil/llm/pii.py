"""Personal data by a skip-chain conditional random field.

Patterns find the base spans (email, ip, card, phone). Around them the field
labels *candidates*: number-like and address-like stretches that no pattern
accepted, such as a phone number without its plus sign or an address written
with "(at)". Base spans are nodes with a known label; candidates take one of
``LABELS`` (0 is "no personal data").

Factors, trained piecewise from counts over all documents (each factor is fitted
by its own conditional frequencies, which needs only small count tables). Only
shares within a class are used, each weighing ``WEIGHT`` observations, so copies
and look-alikes of a document do not change what the field finds in it:

- *unary*: label given the shape of the stretch (digits, separators) and the
  word before it;
- *chain*: labels of neighbouring nodes at most ``NEAR`` characters apart;
- *skip*, of fixed strength ``SKIP``, above all that the other factors can say
  against it (a shape 6.1, a word 2.1, two neighbours 2): labels of distant
  nodes whose texts repeat or resemble each other: the
  same letters and digits after normalising, or numbers of 7 to 15 digits of
  which one is the end of the other.

All candidates with one value share one variable, with the mean of their unaries
and chain factors: the value is judged once, however often it occurs, and any
base span of this value is one edge away from all of them. Numbers look up their
own ends, so the number of edges is linear.

Loopy sum-product message passing (damped, until the messages settle) gives each
candidate's marginals; it becomes a span when one kind reaches ``ACCEPT``. A
candidate with no skip edge to evidence stays what its shape and neighbours make
it, which on clean text is no personal data.

Documents are independent: no shuffle but the small count tables. Nulls and
empty texts have no spans. The patterns run in linear time on long texts.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import map_batches, text_list

KINDS = ("email", "ip", "card", "phone")          # fixed values: kinds in the contract's order
LABELS = len(KINDS) + 1
NEAR = 32
SETTLED = 1e-6                                    # greatest change of a message in the last sweep
LOOPS = 100                                       # sweeps, besides one per variable, after which loops count as settled
DAMPING = 0.5
ACCEPT = 0.6
SMOOTH = 1.0
UNSEEN_CLEAN = 0.9
WEIGHT = 10.0                                     # observations that a class counts for, however often it was seen
CUE_LIMIT = 2.0
CHAIN_LIMIT = 0.5
SKIP = 12.0
CUES = 256                                        # classes of the word before a candidate

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot start inside a run of digits: the run's first digit matches too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){2}\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"\(?[0-9](?:[ ().-]{0,2}[0-9]){6,}+")
_RUN = re.compile(r"[0-9]+")
_SPELT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]{1,63})+",
                    re.I)
_AT = re.compile(r" ?[\[(]at[\])] ?", re.I)
_DOT = re.compile(r" ?[\[(]dot[\])] ?", re.I)
_WORD_BEFORE = re.compile(r"(\S{1,24})\s{1,3}\Z")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            found.append((start, host.end()))
            free = host.end()
        else:
            free = max(free, at + 1)                 # a later match cannot reach back over this sign
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the contract's patterns, by start, then kind."""
    spans = []
    if "@" in text:
        spans += [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                      if all(len(q) <= 3 and int(q or 0) <= 255 for q in (p.lstrip("0") for p in m.group().split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    spans.append((m.start(), 3, m.end()))
    spans.sort()
    return spans


def _ends(key: str) -> list[str]:
    """The proper ends of 7 digits or more of a number of at most 15."""
    return [key[cut:] for cut in range(1, len(key) - 6)] if len(key) <= 15 else []


def _numbers(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Number-like stretches between the base spans. A stretch that is related
    to no other number of the text may be several numbers in a row: from the
    left, the most runs that together repeat a number or its end stand alone,
    and a rest that cannot be one number is offered run by run."""
    stretches, at = [], 0
    for s, e in [*sorted((s, e) for s, _, e in taken), (len(text), len(text))]:
        if s > at:
            stretches += [m.span() for m in _NUMBER.finditer(text, at, s)]
        at = max(at, e)
    if not stretches:
        return []
    whole = Counter(_normal(text[s:e]) for s, e in stretches)
    base = {key for key in (_normal(text[s:e]) for s, _, e in taken) if key.isdigit()}
    known = base | {key for key in whole if 7 <= len(key) <= 19}
    ends = {end for key in known for end in _ends(key)}
    found = []
    for s, e in stretches:
        runs = [(m.start() - (m.start() > s and text[m.start() - 1] == "("), m.end(), m.group())
                for m in _RUN.finditer(text, s, e)]
        key = "".join(r[2] for r in runs)
        again = key in base or whole[key] > 1 and len(key) <= 19
        if len(runs) == 1 or again or key in ends or any(end in known for end in _ends(key)):
            found.append((s, e))
            continue
        i, rest = 0, []
        while i < len(runs):
            part, best = "", None
            for j in range(i, len(runs)):
                part += runs[j][2]
                if len(part) > 19:
                    break
                if len(part) >= 7 and j - i + 1 < len(runs) and (part in known or part in ends):
                    best = j
            if best is None:
                rest.append(runs[i])
                i += 1
            else:
                found += _rest(rest)
                found.append((runs[i][0], runs[best][1]))
                i, rest = best + 1, []
        found += _rest(rest)
    return found


def _rest(runs: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Runs of one stretch that repeat nothing, as one number if they may be one."""
    key = "".join(r[2] for r in runs)
    if len(key) > 15 and not (len(key) <= 19 and luhn(key)) and any(len(r[2]) >= 7 for r in runs):
        return [r[:2] for r in runs if len(r[2]) >= 7]
    return [(runs[0][0], runs[-1][1])] if len(key) >= 7 else []


def _candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches that may be personal data and touch no base span."""
    found = _numbers(text, taken) if _DIGIT.search(text) else []
    if "at" in text or "AT" in text:
        if "(" in text or "[" in text:
            found += [m.span() for m in _SPELT.finditer(text)]
    found.sort()
    free, k, reach = [], 0, 0
    busy = sorted((s, e) for s, _, e in taken)
    last = 0
    for s, e in found:
        while k < len(busy) and busy[k][0] < e:
            reach = max(reach, busy[k][1])
            k += 1
        if s >= reach and s >= last:
            free.append((s, e))
            last = e
    return free


def _normal(part: str) -> str:
    part = _DOT.sub(".", _AT.sub("@", part)).lower()
    if "@" in part:
        return part
    return "".join(c for c in part if c.isalnum())


def _shape(part: str) -> int:
    """Bounded class of a stretch: digits (to 24), kinds of separators, letters.
    The plus sign is left out: it is what candidates lack."""
    digits = min(24, sum(c.isdigit() for c in part))
    seps = sum(1 << k for k, c in enumerate(" -.(") if c in part)
    return (digits * 16 + seps) * 2 + ("@" in part or "at" in part.lower())


def _admissible(part: str) -> np.ndarray:
    """Log penalties of the labels a stretch cannot carry by its form: an
    address needs a host, a card number 12 to 19 digits that pass Luhn, a phone
    number 7 to 15 digits; what the ip pattern rejects is no ip."""
    key = _normal(part)
    digits = key if key.isdigit() else ""
    ok = [True, _HOST.search(key.partition("@")[2]) is not None, False,
          12 <= len(digits) <= 19 and luhn(digits), 7 <= len(digits) <= 15]
    return np.where(ok, 0.0, -50.0)


def _cue(text: str, start: int) -> int:
    m = _WORD_BEFORE.search(text[max(0, start - 28):start])
    if not m:
        return 0
    word = m.group(1).lower().strip(".,:;|\"'()[]=*#")
    return 1 + hashlib.md5(word.encode()).digest()[0] % (CUES - 1)


def graph(text: str, spans: list[tuple[int, int, int]]):
    """Nodes (start, end, label or -1, shape, cue) in text order, chain edges and
    skip edges as index pairs. The first candidate of a value has the skip edges
    of all, see ``variables``; two base spans need none."""
    free = _candidates(text, spans)
    nodes = sorted([(s, e, kind + 1) for s, kind, e in spans] + [(s, e, -1) for s, e in free])
    described = []
    for s, e, label in nodes:
        part = text[s:e]
        described.append((s, e, label, _shape(part.lstrip("+")), _cue(text, s)))
    chain = [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1][0] - nodes[i][1] <= NEAR]
    known: dict[str, list[int]] = defaultdict(list)
    open_: dict[str, int] = {}
    for i, (s, e, label) in enumerate(nodes):
        key = _normal(text[s:e])
        if label > 0:
            known[key].append(i)
        else:
            open_.setdefault(key, i)
    skip = {(k, i) for key, i in open_.items() for k in known.get(key, ())}
    if open_:
        first = {key: {nodes[i][2]: i for i in reversed(at)}.values() for key, at in known.items()}   # one per label
        for key in [k for k in known.keys() | open_.keys() if k.isdigit()]:
            for end in _ends(key):
                if end in open_:
                    skip.update((i, open_[end]) for i in first.get(key, ()))
                if key in open_:
                    skip.update((i, open_[key]) for i in first.get(end, ()))
                    if end in open_:
                        skip.add((open_[key], open_[end]))
    return described, chain, sorted(skip)


def variables(text: str, nodes) -> np.ndarray:
    """The variable of each node: its own for a base span, one per value for candidates."""
    ids: dict[object, int] = {}
    return np.array([ids.setdefault(i if label > 0 else _normal(text[start:end]), len(ids))
                     for i, (start, end, label, _, _) in enumerate(nodes)], dtype=np.int64)


def _label(node) -> int:
    return max(node[2], 0)


def piecewise_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(factor, x, y, n): counts of every factor over all documents, where a
    candidate counts as label 0. All keys come from bounded classes."""
    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter = Counter()
        for text in text_list(batch.column(0)):
            spans = base_spans(text)
            nodes, chain, _ = graph(text, spans)
            for n in nodes:
                counts["shape", n[3], _label(n)] += 1
                counts["cue", n[4], _label(n)] += 1
            for i, j in chain:
                counts["chain", _label(nodes[i]), _label(nodes[j])] += 1
        keys = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
            ["factor", "x", "y", "n"])

    return map_batches(docs.select(text_col), fn, "factor string, x int, y int, n bigint").groupBy(
        "factor", "x", "y").agg(F.sum("n").alias("n"))


def fit(counts: list[tuple[str, int, int, int]]) -> dict[str, object]:
    """Log factors from the count table. A candidate is no proof of clean text:
    it counts as label 0 by its share of a class, never by its number."""
    by: dict[str, dict[int, np.ndarray]] = defaultdict(lambda: defaultdict(lambda: np.zeros(LABELS)))
    for factor, x, y, n in counts:
        by[factor][x][y] += n
    # A stretch of a class that was never seen is held to be no personal data:
    # only evidence from other nodes can overrule that.
    prior = np.log([UNSEEN_CLEAN] + [(1 - UNSEEN_CLEAN) / len(KINDS)] * len(KINDS))

    def conditional(row):
        row = WEIGHT * row / row.sum() + SMOOTH * np.exp(prior)
        return np.log(row / row.sum())

    # The cue adds its evidence relative to the prior, so the two unary
    # factors do not count the prior twice.
    unary = {x: conditional(r) for x, r in by["shape"].items()}
    cue = {x: conditional(r) - prior for x, r in by["cue"].items()}
    chain = np.stack([by["chain"][x] for x in range(LABELS)])
    chain = np.log(WEIGHT * chain / max(chain.sum(), 1.0) + SMOOTH / LABELS ** 2)
    chain -= np.logaddexp.reduce(chain, axis=None)
    rows, cols = np.logaddexp.reduce(chain, axis=1), np.logaddexp.reduce(chain, axis=0)
    return {"prior": prior, "unary": unary, "cue": cue, "skip": SKIP,
            "chain": np.clip(chain - rows[:, None] - cols[None, :], -CHAIN_LIMIT, CHAIN_LIMIT)}


def marginals(text, nodes, chain, skip, model) -> np.ndarray:
    """Label marginals of every node by loopy sum-product; rows add to one."""
    n = len(nodes)
    unary = np.empty((n, LABELS))
    for i, (start, end, label, shape, cue) in enumerate(nodes):
        if label > 0:                                     # known
            unary[i] = -50.0
            unary[i, label] = 0.0
        else:
            unary[i] = model["unary"].get(shape, model["prior"]) + np.clip(
                model["cue"].get(cue, 0.0), -CUE_LIMIT, CUE_LIMIT) + _admissible(text[start:end])
    var = variables(text, nodes)
    size = np.bincount(var)
    mean = np.zeros((len(size), LABELS))
    np.add.at(mean, var, unary)
    unary = mean / size[:, None]
    same = model["skip"] * np.eye(LABELS)
    pairs, factors = [], []
    for i, j in chain:
        if var[i] != var[j]:
            pairs.append((var[i], var[j]))
            factors.append(model["chain"] / max(size[var[i]], size[var[j]]))
    for i, j in skip:
        pairs.append((var[i], var[j]))
        factors.append(same)
    belief = unary.copy()
    if pairs:
        src = np.array([p[0] for p in pairs] + [p[1] for p in pairs])
        dst = np.array([p[1] for p in pairs] + [p[0] for p in pairs])
        e = len(pairs)
        factor = np.stack(factors)
        factor = np.concatenate([factor, factor.transpose(0, 2, 1)])   # [edge, label of src, label of dst]
        back = np.concatenate([np.arange(e, 2 * e), np.arange(e)])
        messages = np.zeros((2 * e, LABELS))
        for _ in range(LOOPS + len(size)):
            out = belief[src] - messages[back]
            new = np.logaddexp.reduce(out[:, :, None] + factor, axis=1)
            new -= np.logaddexp.reduce(new, axis=1)[:, None]
            change = np.abs(new - messages).max()
            messages = DAMPING * messages + (1 - DAMPING) * new
            belief = unary.copy()
            np.add.at(belief, dst, messages)
            if change < SETTLED:
                break
    belief -= belief.max(axis=1, keepdims=True)
    out = np.exp(belief)
    return (out / out.sum(axis=1, keepdims=True))[var]


def label_spans(text: str, model) -> tuple[list, list]:
    """(base spans, all spans) of one text, each as (start, kind, end)."""
    spans = base_spans(text)
    nodes, chain, skip = graph(text, spans)
    added = []
    if any(node[2] < 0 for node in nodes):
        for node, p in zip(nodes, marginals(text, nodes, chain, skip, model)):
            kind = int(np.argmax(p[1:]))
            if node[2] < 0 and p[1 + kind] >= ACCEPT:
                added.append((node[0], kind, node[1]))
    return spans, sorted(spans + added)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def masked(text: str, spans) -> str:
    """The text with every span replaced by its kind; of overlapping spans the
    one that starts first (then the longest) names the replacement."""
    out, at = [], 0
    for s, k, e in sorted(spans, key=lambda x: (x[0], -x[2])):
        if e <= at:
            continue
        if s >= at:
            out.append(text[at:s] + f"<{KINDS[k].upper()}>")
        at = e
    return "".join(out) + text[at:]


def train(docs: DataFrame, text_col: str = "text") -> dict[str, object]:
    """Fit the field on all documents. The count table that reaches the driver
    has at most (800 shapes + CUES cues + LABELS) * LABELS rows."""
    rows = piecewise_counts(docs, text_col).collect()
    return fit([(r["factor"], r["x"], r["y"], r["n"]) for r in rows])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model=None) -> DataFrame:
    """(id, counts per kind and digest of the base spans, all spans, masked
    text); ``masked`` is null where nothing was found, else the new text."""
    if model is None:
        model = train(docs, text_col)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "masked"]
    types = [pa.int64()] * 4 + [pa.string()] * 3

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in text_list(batch.column(1)):
            base, spans = label_spans(text, model)
            rows.append((*[sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))],
                         hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans),
                         masked(text, spans) if spans else None))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], ["doc_id", *names])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return map_batches(source, fn, f"doc_id {id_type}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                                   "base_sha256 string, spans string, masked string").withColumnRenamed("doc_id", id_col)


def mask_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", model=None) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind, and
    ``chars_col`` (if there) counting the new text. Other rows and columns stay."""
    if model is None:
        model = train(docs, text_col)

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index(text_col)
        out = []
        for text in batch.column(at).to_pylist():
            spans = label_spans(text, model)[1] if text else []
            out.append(masked(text, spans) if spans else text)
        return batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    hidden = map_batches(docs, fn, schema)
    if chars_col in docs.columns:
        hidden = hidden.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return hidden


def op5_query(docs: DataFrame) -> DataFrame:
    return find_personal_data(docs).drop("masked")
