"""Secret scans: rules for known shapes, and a character convolutional network for the rest.

The network reads every candidate whole, with CONTEXT characters on both sides, in chunks
that overlap by WIDTH - 1; a filter's maximum is over all chunks. Each character is an id (letters without
case) and two flags, upper case and inside the candidate; a convolution of WIDTH
characters, the maximum over all places and a logistic unit give a margin. It is
trained with Adam in numpy on labelled findings. Two folds are kept apart: on one its
margins are calibrated by Platt scaling, on the other the threshold is the largest one for which
an exact binomial bound says, at RISK, that the recall asked for is kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vectorloom.llm.common import narrow, replaced, rows, slices

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{32,}")
#: What the network judges besides the rules' findings: long runs, or what a rule's finding leaves of them.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
KINDS = ("assign", "access", "hex", "model")
CONTEXT, CHUNK, WIDTH, FILTERS, EMBEDDED = 24, 128, 5, 24, 8
#: The chance that a threshold does not keep the recall, and the number of generated findings.
RISK, FINDINGS = 0.05, 8000
_MARKS = "\"':=.,;/+-_@#&%?!()[]{}<>"
_IDS = np.full(129, 28, dtype=np.int64)  # 28: any other character
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyz"):
    _IDS[ord(_c)] = _IDS[ord(_c.upper())] = _i + 1
_IDS[48:58] = 27
_IDS[[32, 9, 10, 13]] = 29
for _i, _c in enumerate(_MARKS):
    _IDS[ord(_c)] = 30 + _i
VOCABULARY = 30 + len(_MARKS)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' findings, in order; kinds by their place in KINDS."""
    found = []
    low = text.lower()
    if any(word in low for word in ("passw", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of 16 characters or more; of a run that meets findings of the rules, the parts outside of them."""
    out, k = [], 0
    for m in CANDIDATE.finditer(text):
        at, end = m.span()
        while k < len(taken) and taken[k][2] <= at:
            k += 1
        for s, _, e in taken[k:]:
            if s >= end:
                break
            if s > at:
                out.append((at, s))
            at = max(at, e)
        if at < end:
            out.append((at, end))
    return out


def windows(items: list[tuple[str, int, int]], size: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character ids and the two flags of each (text, start, end) in chunks of size, and the first chunk of each.

    WIDTH empty places stand on both sides. Without a size each has one chunk.
    """
    read = [(start - max(0, start - CONTEXT), text[max(0, start - CONTEXT) : end + CONTEXT]) for text, start, end in items]
    size = size or max((len(own) for _, own in read), default=0) + 2 * WIDTH
    step = size - WIDTH + 1
    number = [max(1, -(-(len(own) + WIDTH + 1) // step)) for _, own in read]
    first = np.cumsum([0, *number])
    ids, flags = np.zeros((first[-1], size), np.int64), np.zeros((first[-1], size, 2), np.float32)
    for i, ((before, own), (_, start, end)) in enumerate(zip(read, items, strict=True)):
        points = np.frombuffer(own.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        long = np.zeros(number[i] * step + WIDTH - 1, np.int64)
        flag = np.zeros((len(long), 2), np.float32)
        long[WIDTH : WIDTH + len(points)] = _IDS[np.minimum(points, 128)]
        flag[WIDTH : WIDTH + len(points), 0] = (points >= 65) & (points <= 90)
        flag[WIDTH + before : WIDTH + before + end - start, 1] = 1
        for k in range(number[i]):
            ids[first[i] + k], flags[first[i] + k] = long[k * step : k * step + size], flag[k * step : k * step + size]
    return ids, flags, first[:-1]


@dataclass
class Network:
    embedding: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 0.5

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.shift, self.out, self.bias]

    def forward(self, ids: np.ndarray, flags: np.ndarray) -> tuple:
        x = np.concatenate([self.embedding[ids], flags], axis=2)
        seen = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1).reshape(len(ids), ids.shape[1] - WIDTH + 1, -1)
        z = seen @ self.filters + self.shift
        at = z.argmax(axis=1)
        top = np.maximum(np.take_along_axis(z, at[:, None], axis=1)[:, 0], 0)
        return seen, at, top, top @ self.out + self.bias[0]

    def probability(self, items: list[tuple[str, int, int]]) -> np.ndarray:
        """Calibrated probability of each candidate."""
        made = []
        for k in range(0, len(items), 512):
            ids, flags, first = windows(items[k : k + 512], CHUNK)
            top = np.concatenate([self.forward(ids[j : j + 512], flags[j : j + 512])[2] for j in range(0, len(ids), 512)])
            made.append(np.maximum.reduceat(top, first, axis=0) @ self.out + self.bias[0])
        return 1 / (1 + np.exp(-np.clip(self.slope * np.concatenate(made) + self.offset, -30, 30))) if made else np.empty(0)


def misses(n: int, share: float, risk: float) -> int:
    """The most misses among n that have a chance of `risk` or less where the share missed is `share` or more; -1 if not even none has."""
    total, chance, k = 0.0, (1 - share) ** n, 0
    while k <= n and total + chance <= risk:
        total += chance
        chance *= (n - k) / (k + 1) * share / (1 - share)
        k += 1
    return k - 1


def trained(labelled: list[tuple[str, int, int, int]], recall: float = 0.98, epochs: int = 8, batch: int = 64, rate: float = 3e-3, seed: int = 5) -> Network:
    """A network from labelled findings (text, start, end, 1 or 0); of five, one is kept apart for calibration and one for the threshold.

    Where that fold has too few secrets for the bound, the threshold misses none of them.
    """
    random = np.random.default_rng(seed)
    wide = EMBEDDED + 2
    net = Network(
        random.normal(0, 0.3, (VOCABULARY, EMBEDDED)).astype(np.float32), random.normal(0, (2 / (WIDTH * wide)) ** 0.5, (WIDTH * wide, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32), random.normal(0, 0.3, FILTERS).astype(np.float32), np.zeros(1, np.float32),
    )
    y = np.array([x[3] for x in labelled], dtype=np.float32)
    ids, flags, _ = windows([x[:3] for x in labelled])
    fold = np.arange(len(y)) % 5
    learn = np.flatnonzero(fold > 1)
    first, second, step = [np.zeros_like(p) for p in net.parts], [np.zeros_like(p) for p in net.parts], 0
    for _ in range(epochs):
        order = random.permutation(learn)
        for k in range(0, len(order), batch):
            own = order[k : k + batch]
            seen, at, top, margin = net.forward(ids[own], flags[own])
            d = ((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[own]) / len(own)).astype(np.float32)
            by_top = d[:, None] * net.out * (top > 0)
            hit = seen[np.arange(len(own))[:, None], at]  # (batch, FILTERS, WIDTH * wide): what each filter's maximum saw
            g_filters = np.einsum("bf,bfw->wf", by_top, hit)
            by_input = (by_top[:, :, None] * net.filters.T[None]).reshape(len(own), FILTERS, wide, WIDTH)[:, :, :EMBEDDED]
            where = ids[own][np.arange(len(own))[:, None, None], at[:, :, None] + np.arange(WIDTH)]
            g_embedding = np.zeros_like(net.embedding)
            np.add.at(g_embedding, where.ravel(), by_input.transpose(0, 1, 3, 2).reshape(-1, EMBEDDED))
            step += 1
            for p, g, m, v in zip(net.parts, (g_embedding, g_filters, by_top.sum(axis=0), top.T @ d, d.sum(keepdims=True)), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    margin, truth = net.forward(ids[fold == 0], flags[fold == 0])[3], y[fold == 0]
    for _ in range(300 * bool(len(truth))):  # Platt scaling by gradient descent on two numbers
        d = 1 / (1 + np.exp(-np.clip(net.slope * margin + net.offset, -30, 30))) - truth
        net.slope -= 0.05 * float((d * margin).mean())
        net.offset -= 0.05 * float(d.mean())
    own = (fold == 1) & (y > 0)
    positive = np.sort(1 / (1 + np.exp(-np.clip(net.slope * net.forward(ids[own], flags[own])[3] + net.offset, -30, 30)))) if own.any() else ()
    net.threshold = float(positive[max(0, misses(len(positive), 1 - recall, RISK))]) if len(positive) else 0.5
    return net


def labelled_findings(n: int = FINDINGS, seed: int = 11) -> list[tuple[str, int, int, int]]:
    """Generated findings with labels, half of them secrets, in contexts of made-up prose and settings.

    Secrets: random keys in base 64, hex, upper case and mixed alphabets. Others: long
    words with numbers, addresses, paths, dates, versions and names joined by marks, with and
    without digits, lines of marks, and long numbers. Keys also stand at the end of long paths
    and names, and beside a digest that a rule finds, as paths do.
    """
    r = np.random.default_rng(seed)
    pick = lambda s: s[int(r.integers(len(s)))]
    chars = lambda alphabet, k: "".join(alphabet[i] for i in r.integers(0, len(alphabet), k))
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    syllables = ["the", "ing", "on", "er", "and", "re", "es", "in", "at", "th", "or", "en", "ed", "is", "it", "al", "ar", "st", "to", "nt", "que", "ción", "lich", "ung", "ver"]
    word = lambda: "".join(pick(syllables) for _ in range(int(r.integers(1, 4))))
    secrets = [
        lambda: chars(upper + lower + digits, int(r.integers(20, 50))), lambda: chars(upper + lower + digits + "+/", int(r.integers(22, 60))) + pick(["", "=", "=="]),
        lambda: chars(digits + "abcdef", int(r.integers(20, 31))), lambda: chars(digits + "ABCDEF", int(r.integers(24, 65))), lambda: chars(upper + digits, int(r.integers(16, 32))),
        lambda: pick(["sk-", "ghp_", "xoxb-", "pk_live_", "glpat-", "AIza"]) + chars(upper + lower + digits, int(r.integers(20, 40))), lambda: chars(lower + digits, int(r.integers(20, 41))), lambda: chars(lower + upper + digits + "_-", int(r.integers(24, 48))),
        lambda: "/".join(word() for _ in range(int(r.integers(3, 12)))) + pick("/=_") + chars(upper + lower + digits, int(r.integers(24, 50))), lambda: chars(upper + lower, int(r.integers(24, 60))),
    ]
    others = [
        lambda: word() + word() + word() + word() + word() + str(int(r.integers(1, 10_000))), lambda: "-".join(word() for _ in range(4)) + "-" + str(int(r.integers(1, 3000))),
        lambda: "/".join([word() for _ in range(4)] + [str(int(r.integers(1, 100)))]), lambda: "_".join([word(), word(), word(), word(), "v" + str(int(r.integers(1, 30)))]),
        lambda: f"{int(r.integers(1990, 2030))}-{int(r.integers(10, 13))}-{int(r.integers(10, 29))}T{int(r.integers(100000, 235959))}Z", lambda: word().upper() + word().upper() + word().upper() + word().upper() + word().upper() + str(int(r.integers(1, 1000))),
        lambda: "=" * int(r.integers(8, 20)) + word() + str(int(r.integers(1, 100))) + "=" * int(r.integers(8, 20)), lambda: "Chapter" + word().title() + word().title() + word() + str(int(r.integers(1, 60))), lambda: chars("xyz"[int(r.integers(3))], 20) + pick(digits),
        lambda: pick("/-_").join(word() for _ in range(int(r.integers(4, 16)))), lambda: "".join(word() for _ in range(int(r.integers(4, 8)))), lambda: "".join(word().title() for _ in range(int(r.integers(4, 8)))),
        lambda: pick("=-_/+") * int(r.integers(16, 80)), lambda: chars(digits, int(r.integers(16, 40))), lambda: "_".join(word().upper() for _ in range(int(r.integers(3, 7)))),
    ]
    before = [lambda: "key=", lambda: 'auth: "', lambda: "Authorization: Bearer ", lambda: "credential = '", lambda: "", lambda: "(", lambda: "see ", lambda: 'id="', lambda: "https://", lambda: "\n"]
    out = []
    for i in range(n):
        own = pick(secrets if i % 2 else others)()
        own = own if len(own) >= 16 else own + chars(lower, 16 - len(own))
        left = " ".join(word() for _ in range(int(r.integers(0, 8)))) + pick([" ", " ", "\n", ""]) + pick(before)()
        if r.random() < 0.1:  # beside a digest
            digest = chars(digits + "abcdef", 32)
            left, own = (left + digest, own) if i % 2 else (left, own + pick("/-_="))
            after = "" if i % 2 else digest
        else:
            after = ""
        text = left + own + after + pick(['"', "'", " ", "\n", ".", ")", ""]) + " ".join(word() for _ in range(int(r.integers(0, 6))))
        out.append((text, len(left), len(left) + len(own), i % 2))
    return [out[i] for i in r.permutation(n)]


def spans_of(text: str, net: Network) -> list[tuple[int, int, int]]:
    return next(iter(spans_of_all([text], net)))


def spans_of_all(texts: list[str], net: Network) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of all findings of each text, in order."""
    base = [base_spans(t) for t in texts]
    found = [(i, *span) for i, t in enumerate(texts) for span in candidates(t, base[i])]
    good = net.probability([(texts[i], a, b) for i, a, b in found]) >= net.threshold
    for (i, a, b), yes in zip(found, good.tolist(), strict=True):
        if yes:
            base[i].append((a, 3, b))
    return [sorted(x) for x in base]


def findings(docs: DataFrame, labelled: list[tuple[str, int, int, int]] | None = None, recall: float = 0.98, mask: str | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every whole text; with a mask, its masked text too.

    Spans are kind:start:end in code points, end exclusive, by start and then kind as in
    KINDS, comma-joined; base_sha256 is over those of the rules. A mask replaces every
    finding (overlapping ones together). Null texts are empty and, with a mask, stay null;
    repeated rows are scanned each.
    """
    net = docs.sparkSession.sparkContext.broadcast(trained(labelled if labelled is not None else labelled_findings(), recall))
    masked = mask is not None

    def run(batches):
        ids, texts, size = [], [], 0
        for doc_id, text in rows(batches, "doc_id", "text"):
            ids.append(doc_id)
            texts.append(text)
            size += len(text or "")
            if size > 1_000_000 or len(ids) >= 2000:
                yield made(ids, texts)
                ids, texts, size = [], [], 0
        if ids:
            yield made(ids, texts)

    def made(ids, texts):
        spans = spans_of_all([t or "" for t in texts], net.value)
        named = [[(k, f"{KINDS[k]}:{a}:{b}") for a, k, b in own] for own in spans]
        columns = {"doc_id": pa.array(ids, pa.int64())}
        for kind in range(3):
            columns[f"n_{KINDS[kind]}"] = pa.array([sum(k == kind for k, _ in own) for own in named], pa.int64())
        columns["base_sha256"] = pa.array([sha256(",".join(x for k, x in own if k < 3).encode()).hexdigest() for own in named])
        columns["spans"] = pa.array([",".join(x for _, x in own) for own in named])
        if masked:
            columns["masked_text"] = pa.array([t if t is None else without(t, own, mask) for t, own in zip(texts, spans, strict=True)], pa.string())
        return pa.record_batch(columns)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return narrow(docs, doc_id="long", text="string").mapInArrow(run, schema + ", masked_text string" * masked)


def masked(docs: DataFrame, mask: str) -> DataFrame:
    """The rows of docs, with all columns, with a mask in place of every finding of their own text."""
    net = docs.sparkSession.sparkContext.broadcast(trained(labelled_findings()))

    def run(batches):
        for part in slices(batches):
            texts = part.column(part.schema.get_field_index("text")).to_pylist()
            spans = spans_of_all([t or "" for t in texts], net.value)
            yield replaced(part, "text", [without(t, own, mask) if own else t for t, own in zip(texts, spans, strict=True)])

    return docs.mapInArrow(run, docs.schema)


def without(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])
