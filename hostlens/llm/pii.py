"""Personal data in texts: fixed patterns, and a linear-chain conditional random field that adds to them.

The field labels words (O, or the beginning or inside of a kind) from features of their shapes and their
neighbours'. It is trained on a small labelled table by its exact gradient, all sentences at once, and
decodes by Viterbi in numpy batches. A word can only be labelled within REACH words of a digit, an @ or a
spelt-out one; everything else is O, so that the chain falls into short pieces that decode independently, each
with the moves from the O before it and to the O behind it (or with the weights of a text's first and last label).

Nulls and odd cases: a null text counts as empty and has no spans; rows that share a doc_id are searched
one by one; a span of the field that touches a pattern's span is left out; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hostlens.llm.common import chunks

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{b}-{k}" for k in KINDS for b in "BI"))
# E-mails are looked for from each @, IPs from the first digit of a run only, so that no run is gone through more
# than a few times; the matches are those of the plain patterns, from left to right.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT, TOKEN = re.compile("[0-9]"), re.compile(r"[^\x20\x09-\x0D]+")
#: What may be near an entity that the patterns don't know.
ANCHOR = re.compile("[0-9@]")
SPELT = re.compile(r"[\[({<](?:at|dot)[\])}>]|(?<![^\x20\x09-\x0D])dot(?![^\x20\x09-\x0D])", re.I)
REACH, EDGE = 4, ".,;:!?()[]{}<>\"'|"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, behind = text.find("@"), 0  # nothing before ``behind`` can be part of a local part
    while at >= 0:
        front = text[behind:at]
        start = behind + len(front.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        behind = domain.end() if domain else at + 1
        at = text.find("@", behind)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of the patterns' matches, in that order."""
    out = []
    if "@" in text:
        out += [(start, 0, end) for start, end in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(word: str) -> str:
    """Kinds of characters, runs shortened to their length up to 4: 'Ab-1234' is 'Aa-9999'."""
    s = re.sub(r"[a-z\xdf-￿]", "a", re.sub(r"[A-Z\xc0-\xde]", "A", re.sub("[0-9]", "9", word[:40])))
    return re.sub(r"(.)\1{4,}", r"\1\1\1\1", s)


def features(words: list[str], at: int) -> list[str]:
    w = words[at]
    inner, digits = w.strip(EDGE), re.sub("[^0-9]", "", w)
    out = ["bias", f"s={shape(w)}", f"i={shape(inner)}", f"r={re.sub(r'(.)\1+', r'\1', shape(inner))}", f"d={min(len(digits), 20)}",
           f"l={min(len(inner), 12)}", f"w={inner.lower()}" if inner.isalpha() else "w#", f"luhn={13 <= len(digits) <= 19 and luhn(digits)}",
           f"colons={min(w.count(':'), 3)}", f"at={'@' in w}", f"mixed={any(map(str.isalpha, w)) and bool(digits)}/{':' in w}/{'=' in w}", f"tail={w[-1] in '.,;:!?' if w else ''}"]
    for k in (-2, -1, 1, 2):
        other = words[at + k] if 0 <= at + k < len(words) else ""
        bare = other.strip(EDGE)
        out.append(f"{k}r={re.sub(r'(.)\1+', r'\1', shape(bare))}")
        if bare.isalpha():
            out.append(f"{k}w={bare.lower()}")
    return out


@dataclass
class Field:
    index: dict[str, int]
    emit: np.ndarray  # feature x label
    move: np.ndarray  # from x to
    ends: np.ndarray  # first and last label

    def scores(self, sentences: list[tuple[list[str], int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Emission scores of words [a, b) of each sentence, padded, and the lengths."""
        n = np.array([b - a for _, a, b in sentences])
        out = np.zeros((len(sentences), n.max(), len(LABELS)))
        for i, (words, a, b) in enumerate(sentences):
            for t in range(a, b):
                out[i, t - a] = self.emit[[k for f in features(words, t) if (k := self.index.get(f)) is not None]].sum(0)
        return out, n

    def decode(self, sentences: list[tuple[list[str], int, int]]) -> list[np.ndarray]:
        """The best labels of each sentence's words, by Viterbi over batches of similar lengths."""
        out: list[np.ndarray] = [np.zeros(0, int)] * len(sentences)
        order = sorted(range(len(sentences)), key=lambda i: sentences[i][2] - sentences[i][1])
        while order:
            batch = [order.pop()]
            most = sentences[batch[0]][2] - sentences[batch[0]][1]
            while order and (len(batch) + 1) * most < 50_000:
                batch.append(order.pop())
            emit, n = self.scores([sentences[i] for i in batch])
            # a piece within a text has words labelled O on the sides that aren't the text's own
            cut = [(sentences[i][1] > 0, sentences[i][2] < len(sentences[i][0])) for i in batch]
            first = np.array([self.move[0] if a else self.ends[0] for a, _ in cut])
            last = np.array([self.move[:, 0] if b else self.ends[1] for _, b in cut])
            for i, labels in zip(batch, viterbi(emit, n, self.move, np.stack([first, last])), strict=True):
                out[i] = labels
        return out


def viterbi(emit: np.ndarray, n: np.ndarray, move: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """emit: sentence x place x label, padded; n: lengths; ends: weights of the first and the last label, of all
    sentences or by sentence."""
    rows, most, _ = emit.shape
    score, back = ends[0] + emit[:, 0], np.zeros(emit.shape, int)
    last = np.where((n == 1)[:, None], score + ends[1], -np.inf)
    for t in range(1, most):
        way = score[:, :, None] + move
        back[:, t] = way.argmax(1)
        score = way.max(1) + emit[:, t]
        last = np.where((n == t + 1)[:, None], score + ends[1], last)
    label, out = last.argmax(1), np.zeros((rows, most), int)
    for t in range(most - 1, -1, -1):
        inside = t < n
        out[inside, t] = label[inside]
        label = np.where(inside, back[np.arange(rows), t, label], label)
    return [out[i, :k] for i, k in enumerate(n)]


def marked(text: str) -> tuple[str, list[tuple[int, int, int]]]:
    """Text and spans of a labelled row: '{phone|555 0100}' marks a phone."""
    plain, spans = "", []
    for part in re.split(r"(\{(?:" + "|".join(KINDS) + r")\|[^}]*\})", text):
        kind, bar, inside = part[1:-1].partition("|")
        if part.startswith("{") and bar and kind in KINDS:
            spans.append((len(plain), KINDS.index(kind), len(plain) + len(inside)))
            plain += inside
        else:
            plain += part
    return plain, spans


def train(rows: Iterable[str], steps: int = 150, ridge: float = 0.02, rate: float = 0.15) -> Field:
    """Maximum likelihood with a ridge penalty, by Adam on the exact gradient. ``rows`` are marked texts."""
    sentences, gold = [], []
    for row in rows:
        text, spans = marked(row)
        tokens = list(TOKEN.finditer(text))
        if not tokens:
            continue
        sentences.append([m[0] for m in tokens])
        labels = []
        for m in tokens:
            span = next(((a, k, b) for a, k, b in spans if a < m.end() and b > m.start()), None)
            labels.append(0 if span is None else 1 + 2 * span[1] + (m.start() > span[0]))
        gold.append(labels)
    index: dict[str, int] = {}
    held = [[[index.setdefault(f, len(index)) for f in features(s, t)] for t in range(len(s))] for s in sentences]
    n, most, size = np.array(list(map(len, sentences))), max(map(len, sentences), default=1), len(LABELS)
    row = np.array([i for i, s in enumerate(held) for t in s for _ in t], int)
    place = np.array([j for s in held for j, t in enumerate(s) for _ in t], int)
    which = np.array([k for s in held for t in s for k in t], int)
    true = np.zeros((len(n), most, size))
    for i, labels in enumerate(gold):
        true[i, np.arange(len(labels)), labels] = 1
    inside = np.arange(most) < n[:, None]
    sizes = [(max(1, len(index)), size), (size, size), (2, size)]
    x = [np.zeros(s) for s in sizes]
    m, v = [np.zeros(s) for s in sizes], [np.zeros(s) for s in sizes]
    log_sum = lambda a, axis: (top := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - top).sum(axis))
    pairs = np.einsum("nta,ntb->ab", true[:, :-1], true[:, 1:])
    for step in range(1, steps + 1 if len(n) else 1):
        emit = np.zeros((len(n), most, size))
        np.add.at(emit, (row, place), x[0][which])
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = x[2][0] + emit[:, 0]
        for t in range(1, most):
            ahead[:, t] = np.where(inside[:, t, None], log_sum(ahead[:, t - 1, :, None] + x[1], 1) + emit[:, t], ahead[:, t - 1])
        behind[:, most - 1] = x[2][1]
        for t in range(most - 2, -1, -1):
            behind[:, t] = np.where(inside[:, t + 1, None], log_sum(x[1] + (emit[:, t + 1] + behind[:, t + 1])[:, None], 2), x[2][1])
        whole = log_sum(ahead[:, -1] + x[2][1], 1)
        p = np.exp(ahead + behind - whole[:, None, None]) * inside[:, :, None]
        both = np.zeros((size, size))
        for t in range(1, most):
            way = ahead[:, t - 1, :, None] + x[1] + (emit[:, t] + behind[:, t])[:, None] - whole[:, None, None]
            both += (np.exp(np.minimum(way, 0)) * inside[:, t, None, None]).sum(0)
        g = [np.zeros(sizes[0]), pairs - both, np.stack([(true - p)[:, 0].sum(0), (true - p)[np.arange(len(n)), n - 1].sum(0)])]
        np.add.at(g[0], which, (true - p)[row, place])
        for k in range(3):
            d = g[k] - ridge * x[k]
            m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.99 * v[k] + 0.01 * d * d
            x[k] += rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return Field(index, *x)


def pieces(text: str) -> list[tuple[list[re.Match], int, int]]:
    """Tokens around anchors: REACH words on either side of one, and two more as context; the range to decode."""
    out, end = [], -1
    anchors = sorted(m.start() for x in (ANCHOR, SPELT) for m in x.finditer(text))
    if not anchors:
        return out
    tokens = list(TOKEN.finditer(text))
    starts = np.array([m.start() for m in tokens])
    for at in np.unique(np.searchsorted(starts, anchors, side="right") - 1).tolist():
        a, b = max(0, at - REACH), min(len(tokens), at + REACH + 1)
        if out and a <= end:
            out[-1][1] = b
        else:
            out.append([a, b])
        end = b
    # a context of two words as far as features look
    return [(tokens[max(0, a - 2) : b + 2], min(a, 2), b - max(0, a - 2)) for a, b in out]


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without the punctuation around it: brackets that don't close within, and colons unless doubled."""

    def loose(c: str, pair: str) -> bool:
        inside = text[start:end]
        return c in ".,;!?\"'|" or c == ":" and "::" != pair or any(c in x and not all(y in inside for y in x) for x in ("()", "[]", "{}", "<>"))

    while start < end and loose(text[start], text[start : start + 2]):
        start += 1
    while start < end and loose(text[end - 1], text[end - 2 : end]):
        end -= 1
    return start, end


def added_spans(texts: list[str], known: list[list[tuple[int, int, int]]], field: Field) -> list[list[tuple[int, int, int]]]:
    """What the field finds in each text beside the ``known`` spans."""
    found = [(i, *p) for i, t in enumerate(texts) for p in pieces(t)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (i, tokens, a, _), labels in zip(found, field.decode([([m[0] for m in ts], a, b) for _, ts, a, b in found]), strict=True):
        t = 0
        while t < len(labels):
            if not labels[t]:
                t += 1
                continue
            kind, to = (labels[t] - 1) // 2, t + 1
            while to < len(labels) and labels[to] == 2 + 2 * kind:
                to += 1
            start, end = trimmed(texts[i], tokens[a + t].start(), tokens[a + to - 1].end())
            if start < end and not any(x < end and y > start for x, _, y in known[i]):
                out[i].append((start, int(kind), end))
            t = to
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of spans replaced by its first kind: '<EMAIL>'."""
    out, at = [], 0
    for a, k, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _find(field: Field, mask: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            texts = [t or "" for t in b["text"].to_pylist()]
            base = [base_spans(t) for t in texts]
            both = [x + y for x, y in zip(base, added_spans(texts, base, field), strict=True)]
            if mask:
                new = [masked(t, s) if s else t for t, s in zip(b["text"].to_pylist(), both, strict=True)]
                b = b.set_column(b.schema.get_field_index("text"), "text", pa.array(new, pa.string()))
                if (at := b.schema.get_field_index("n_chars")) >= 0 and pa.types.is_integer(b.schema.field(at).type):
                    n = [len(t) if s else old for t, s, old in zip(new, both, b["n_chars"].to_pylist(), strict=True)]
                    b = b.set_column(at, "n_chars", pa.array(n, b.schema.field(at).type))
                yield b
                continue
            count = np.array([[sum(k == j for _, k, _ in s) for j in range(len(KINDS))] for s in base], np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"]} | {f"n_{k}": count[:, j] for j, k in enumerate(KINDS)} | {
                "base_sha256": [hashlib.sha256(joined(s).encode()).hexdigest() for s in base], "spans": pa.array([joined(s) for s in both], pa.string())})

    return run


def labelled_rows(table: DataFrame, most: int = 10_000) -> list[str]:
    """The ``text`` column of a small table of marked texts."""
    rows = [r.text for r in table.select("text").limit(most + 1).collect() if r.text]
    if len(rows) > most:
        raise ValueError(f"the labelled table has more than {most} rows")
    return rows


def find(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, the counts of the patterns' spans by kind, base_sha256 of them, and all spans (code points, end exclusive)."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(_find(field, False), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """The documents with all spans masked, and n_chars (if there, as a whole number) to match."""
    return docs.mapInArrow(_find(field, True), docs.schema)
