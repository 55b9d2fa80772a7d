"""Personal data by patterns and a skip-chain conditional random field.

Strict patterns give the base spans. The field goes over the candidate tokens of a document, which
are anything with an at sign and anything number-like, and labels each of them email, ip, card, phone or
other. Neighbouring tokens are joined to a chain; tokens that repeat or resemble one another, however
far apart, are joined by skip edges with potentials of their own. Base spans are evidence: their
tokens are fixed, and loopy message passing carries their labels along the edges, so that a number
written once in full and once without its country code gets one label. Weights are trained on the
base spans of a bounded sample by pseudo-likelihood, with features left out at random so that the
edges learn too.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglean.llm.common import pick, query, slices, table, tidied

KINDS = ("email", "ip", "card", "phone")
#: The training sample: so many texts with a digit or at sign at most, none longer than TEXT_CHARS.
SAMPLE_DOCS, TEXT_CHARS = 3000, 12_000
#: Characters between two tokens that are still neighbours; rounds of message passing; certainty that adds a span.
NEAR, ROUNDS, CERTAIN = 40, 12, 0.8
#: Share of the features that a training round leaves out.
DROPPED = 0.7
_LABELS = len(KINDS) + 1  # 0 is other
_CHAIN, _SKIP = 0, 1

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"\+?[0-9]{1,3}[ ]?\([0-9]{1,5}\)(?:[ .-]?[0-9])++|\+[0-9](?:[ .()-]{0,2}[0-9])++"
                     r"|(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])|[0-9]++(?:[.-][0-9]++)*+")
_AROUND_AT = re.compile(r"[^\s@<>\"',;:()]*+@[^\s@<>\"',;:()]*+")
_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the strict patterns, kind by kind, leftmost and without overlap within a kind."""
    spans: list[tuple[int, int, int]] = []
    last, at = 0, text.find("@")
    while at >= 0:  # a local part reaches back from its at sign, so no start is tried twice
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            spans.append((0, begin, found.end()))
        last = found.end() if found else at + 1
        at = text.find("@", last)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.sub("", m[0])) <= 15:
            spans.append((3, *m.span()))
    return spans


def tokens(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label or -1) of the candidate tokens in order: the base spans, and what else might be one."""
    found = []
    taken_to = 0
    evidence = sorted((a, b, kind + 1) for kind, a, b in base)
    free = []
    for a, b, kind in evidence:
        if a >= taken_to:  # of overlapping base spans the first stands for all
            found.append((a, b, kind))
            free.append((taken_to, a))
            taken_to = b
    free.append((taken_to, len(text)))
    for a, b in free:
        taken = [m.span() for m in _AROUND_AT.finditer(text, a, b)] if text.find("@", a, b) >= 0 else []
        found += [(x, y, -1) for x, y in taken]
        last = 0
        for m in _NUMBER.finditer(text, a, b):
            while last < len(taken) and taken[last][1] <= m.start():
                last += 1
            if last == len(taken) or taken[last][0] >= m.end():
                found.append((*m.span(), -1))
    found.sort()
    return found


def features(text: str, start: int, end: int) -> list[str]:
    """What a token looks like and what stands around it; never whether a strict pattern matched."""
    body = text[start:end]
    digits = _DIGIT.sub("", body)
    parts = body.split(".")
    before = text[max(0, start - 24):start].split()
    names = ["bias", f"digits={min(len(digits), 20)}", f"dots={min(body.count('.'), 5)}",
             f"at={'@' in body}", f"plus={body[0] == '+'}", f"paren={'(' in body}", f"space={' ' in body}",
             f"dash={'-' in body}", f"letters={any(map(str.isalpha, body))}",
             f"long={max(map(len, parts)) > 3}", f"before={before[-1].lower()[-12:] if before else ''}",
             f"left={_around(text[start - 1:start])}", f"right={_around(text[end:end + 1])}"]
    if len(digits) >= 13 and len(digits) <= 19:
        names.append(f"luhn={luhn(digits)}")
    if "@" in body:
        names.append(f"domain={'.' in body.rpartition('@')[2].strip('.')}")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        names.append(f"bytes={all(len(p.lstrip('0')) <= 3 and int(p.lstrip('0') or 0) <= 255 for p in parts)}")
    return names


def _around(c: str) -> str:
    return "end" if not c else "letter" if c.isalpha() else "digit" if c.isdigit() else "space" if c.isspace() else c


def keys(body: str) -> tuple[str | None, str | None]:
    """(key of tokens that are the same, key of tokens that are alike) of a token."""
    digits = _DIGIT.sub("", body)
    if "@" in body:
        name = body.lower()
        return name, "@" + name.partition("@")[0]
    return (digits if len(digits) >= 7 else None), (digits[-7:] if 9 <= len(digits) <= 15 or len(digits) == 7 else None)


def edges(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(token, later token, type): chain neighbours, and each token with the one before of the same key."""
    made = []
    same: dict[str, int] = {}
    alike: dict[str, int] = {}
    for i, (a, b, _) in enumerate(found):
        if i and a - found[i - 1][1] <= NEAR:
            made.append((i - 1, i, _CHAIN))
        one, other = keys(text[a:b])
        if one is not None:
            if one in same:
                made.append((same[one], i, _SKIP))
            same[one] = i
        if other is not None:
            if other in alike and (alike[other], i, _SKIP) != (made or [None])[-1]:
                made.append((alike[other], i, _SKIP))
            alike[other] = i
    return made


@dataclass
class SkipChain:
    """Weights of a trained field."""

    index: dict[str, int]
    node: np.ndarray  # features x labels
    pair: np.ndarray  # edge types x labels x labels

    def infer(self, evidence: np.ndarray, score: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Label probabilities of all tokens (rows) by damped loopy message passing."""
        score = np.where(evidence[:, None] >= 0, np.where(np.arange(_LABELS) == evidence[:, None], 0.0, -50.0), score)
        if not len(edge):
            return _normal(score)
        source = np.r_[edge[:, 0], edge[:, 1]]
        target = np.r_[edge[:, 1], edge[:, 0]]
        pair = np.concatenate([self.pair[edge[:, 2]], self.pair[edge[:, 2]].transpose(0, 2, 1)])
        back = np.r_[np.arange(len(edge)) + len(edge), np.arange(len(edge))]
        message = np.zeros((len(source), _LABELS))
        for _ in range(ROUNDS):
            belief = score + _gather(target, message, len(score))
            sent = (belief[source] - message[back])[:, :, None] + pair
            top = sent.max(axis=1)
            new = top + np.log(np.exp(sent - top[:, None, :]).sum(axis=1))
            message = 0.5 * message + 0.5 * (new - new.max(axis=1, keepdims=True))
        return _normal(score + _gather(target, message, len(score)))

    def scores(self, names: list[list[str]]) -> np.ndarray:
        rows = [[self.index[n] for n in f if n in self.index] for f in names]
        out = np.zeros((len(rows), _LABELS))
        flat = np.fromiter((i for r in rows for i in r), np.int64)
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        for label in range(_LABELS):
            out[:, label] = np.bincount(owner, weights=self.node[flat, label], minlength=len(rows))
        return out


def _gather(target: np.ndarray, message: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(target, weights=message[:, k], minlength=n) for k in range(_LABELS)], axis=1)


def _normal(score: np.ndarray) -> np.ndarray:
    made = np.exp(score - score.max(axis=1, keepdims=True))
    return made / made.sum(axis=1, keepdims=True)


def train(texts: list[str], rounds: int = 120, least: int = 3) -> SkipChain:
    """A field from the base spans of texts: pseudo-likelihood by Adam, most features left out at random in each round."""
    names, label, edge = [], [], []
    for text in texts:
        found = tokens(text, base_spans(text))
        edge += [(a + len(label), b + len(label), t) for a, b, t in edges(text, found)]
        names += [features(text, a, b) for a, b, _ in found]
        label += [max(0, k) for _, _, k in found]
    counts: dict[str, int] = {}
    for f in names:
        for n in f:
            counts[n] = counts.get(n, 0) + 1
    index = {n: i for i, n in enumerate(sorted(n for n, c in counts.items() if c >= least))}
    model = SkipChain(index, np.zeros((len(index) + 1, _LABELS)), np.zeros((2, _LABELS, _LABELS)))
    if not label:
        return model
    y = np.array(label)
    edge = np.array(edge, np.int64).reshape(-1, 3)
    flat = np.fromiter((index[n] for f in names for n in f if n in index), np.int64)
    owner = np.repeat(np.arange(len(names)), [sum(n in index for n in f) for f in names])
    weight = 1 / np.sqrt(np.bincount(y, minlength=_LABELS)[y])  # rare kinds count too
    weight /= weight.sum()
    one = np.eye(_LABELS)
    draw = np.random.default_rng(11)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (model.node, model.pair)]
    for step in range(1, rounds + 1):
        kept = draw.random(len(flat)) > DROPPED
        f, o = flat[kept], owner[kept]
        score = np.stack([np.bincount(o, weights=model.node[f, k], minlength=len(y)) for k in range(_LABELS)], axis=1)
        if len(edge):
            a, b, t = edge.T
            score += _gather(b, model.pair[t, y[a], :], len(y)) + _gather(a, model.pair[t, :, y[b]], len(y))
        error = (_normal(score) - one[y]) * weight[:, None]
        of_node = np.stack([np.bincount(f, weights=error[o, k], minlength=len(model.node)) for k in range(_LABELS)],
                           axis=1) + 2e-4 * model.node
        of_pair = 2e-4 * model.pair
        if len(edge):
            np.add.at(of_pair, (t, y[a]), error[b])
            np.add.at(of_pair.transpose(0, 2, 1), (t, y[b]), error[a])
        for p, g, (m, v) in zip((model.node, model.pair), (of_node, of_pair), moments):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    return model


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, text_column: str = "text") -> SkipChain:
    """A field trained on at most ``sample_docs`` texts (of ``TEXT_CHARS`` characters at most) drawn by their hash."""
    rows = pick(docs, text_column).toDF("text")
    wanted = rows.where(F.length("text").between(1, TEXT_CHARS) & F.col("text").rlike("[0-9@]"))
    n = wanted.count()
    draw = (F.xxhash64("text", F.lit("private")) / F.lit(float(2**63)) + 1) / 2
    found = (wanted.withColumn("draw", draw).where(F.col("draw") <= 1.5 * sample_docs / max(1, n)).distinct()
             .orderBy("draw", "text").limit(sample_docs).collect())
    return train([r["text"] for r in found])


def label(texts: list[str | None], model: SkipChain) -> list[list[tuple[str, int, int, bool, float]]]:
    """(kind, start, end, from a pattern, probability) of each text, by kind as listed, then start."""
    evidence, names, edge, where, out = [], [], [], [], []
    for d, text in enumerate(texts):
        text = text or ""
        base = base_spans(text)
        out.append([(k, a, b, True, 1.0) for k, a, b in base])
        found = tokens(text, base)
        if any(k < 0 for _, _, k in found):
            edge += [(a + len(where), b + len(where), t) for a, b, t in edges(text, found)]
            evidence += [k for _, _, k in found]
            names += [features(text, a, b) for a, b, _ in found]
            where += [(d, a, b) for a, b, _ in found]
    if where:
        chance = model.infer(np.array(evidence), model.scores(names), np.array(edge, np.int64).reshape(-1, 3))
        best = chance[:, 1:].argmax(axis=1)
        for i in np.flatnonzero((np.array(evidence) < 0) & (chance[np.arange(len(best)), best + 1] >= CERTAIN)):
            d, a, b = where[i]
            out[d].append((int(best[i]), a, b, False, float(chance[i, best[i] + 1])))
    return [[(KINDS[k], a, b, strict, p) for k, a, b, strict, p in sorted(spans)] for spans in out]


def find(docs: DataFrame, model: SkipChain, id_column: str = "doc_id", text_column: str = "text",
         carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, carried columns, spans, masked) of every whole text.

    ``spans`` has (kind, start, end, strict, probability) by kind as listed, then start, in characters with
    exclusive ends; ``masked`` is the text with every span replaced by its kind in brackets, overlapping
    spans by that of the first. Null texts are empty: no spans, and masked is null as the text was. Equal rows
    give equal rows; an empty table gives an empty one. One pass, no shuffle.
    """
    rows = pick(docs, id_column, text_column, *carry)
    types = dict(rows.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in rows.columns),
                        "spans array<struct<kind:string,start:int,end:int,strict:boolean,probability:double>>",
                        "masked string"])
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("strict", pa.bool_()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_column):
                texts = part.column(text_column).to_pylist()
                found = label(texts, model)
                named = [[dict(zip(("kind", "start", "end", "strict", "probability"), s)) for s in f] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(named, span),
                     pa.array([t if t is None else mask(t, f) for t, f in zip(texts, found)], pa.string())],
                    names=[*part.schema.names, "spans", "masked"])

    return rows.mapInArrow(tidied(run), schema)


def mask(text: str, spans: list[tuple]) -> str:
    pieces, place = [], 0
    for start, end, kind in sorted((s[1], s[2], s[0]) for s in spans):
        if start >= place:
            pieces += [text[place:start], f"[{kind.upper()}]"]
        place = max(place, end)
    return "".join([*pieces, text[place:]])


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


@query("op9_personal_data")
def op9_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = find(docs, fit(docs))
    strict = F.filter("spans", lambda s: s["strict"])
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id", *[F.size(F.filter(strict, _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(strict), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
