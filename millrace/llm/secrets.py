"""Secret scans: fixed patterns, and a character convolutional network over every other candidate.

Candidates are, of all runs of LEAST_MODEL key characters or more, the parts outside
the base patterns' matches and their pieces between / . and =, if they have that
length. A base match needs no judgement: it stays. The network, numpy alone, sees
INSIDE characters of a candidate and those around it; overlapping windows cover a longer
one, and the highest score counts. It is trained on a generated set of
labelled findings (formats of published key types against identifiers, numbers,
addresses, paths, long words, rules of signs), calibrated by temperature on a second part, and
its threshold is the highest that keeps RECALL of that part's findings. Base
matches always stay; the network adds spans that overlap none of them.

Spans are (kind, start, end) in code points, end exclusive; order is by start, then
by kind as in KINDS.

Defined results: null and empty texts have no spans; very long texts are scanned
whole; repeated rows each have their spans; of equal candidates each place
counts; overlapping base spans of different kinds all stay; other columns are
ignored by `scan` and kept by `redact`, null texts too; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Every match of ACCESS and HEX that is long enough lies in such a run.
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
#: The rest of a run, between characters that join keys to hosts, paths and names.
PIECE = re.compile(r"[A-Za-z0-9+_-]+")
_WORDS = ("password", "passwd", "secret", "token", "api")
LEAST_MODEL = 16
MASK = "[secret]"

BEFORE, INSIDE, AFTER = 24, 48, 8
LENGTH = BEFORE + INSIDE + AFTER
EXAMPLES = 3200
FILTERS, WIDTH, DIMS = 16, 5, 8
RECALL = 0.99
_CLASSES = 48

Span = tuple[str, int, int]


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """The fixed patterns' spans, and the candidates that the network may judge."""
    spans: list[Span] = []
    lowered = text.lower()
    if any(map(lowered.__contains__, _WORDS)):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    runs = []
    for m in RUN.finditer(text):
        run, at = m[0], m.start()
        spans += [("access", at + x.start(), at + x.end()) for x in ACCESS.finditer(run) if len(x[0]) >= 20] if "AKIA" in run else []
        if len(run) >= 24:
            spans += [("hex", at + x.start(), at + x.end()) for x in HEX.finditer(run) if len(x[0]) >= 24]
        runs.append(m.span())
    taken, first, others = sorted(s[1:] for s in spans), 0, []
    for a, b in runs:
        while first < len(taken) and taken[first][1] <= a:
            first += 1
        at, k = a, first
        while k < len(taken) and taken[k][0] < b:
            others += _candidates(text, at, taken[k][0])
            at, k = max(at, taken[k][1]), k + 1
        others += _candidates(text, at, b)
    return spans, others


def _candidates(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """A part of a run, and its pieces."""
    if end - start < LEAST_MODEL:
        return []
    pieces = [(start + m.start(), start + m.end()) for m in PIECE.finditer(text[start:end]) if LEAST_MODEL <= len(m[0]) < end - start]
    return [(start, end), *pieces]


def windows(start: int, end: int) -> list[tuple[int, int]]:
    """What the network sees of a candidate: the candidate, and from its first INSIDE characters on, INSIDE at a time by half, to its end."""
    return [(start, end)] + [(min(at, end - INSIDE), min(at, end - INSIDE) + INSIDE) for at in range(start + INSIDE // 2, end - INSIDE // 2, INSIDE // 2)] if end - start > INSIDE else [(start, end)]


def ordered(spans: list[Span]) -> list[Span]:
    """By start, then by kind."""
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    """kind:start:end, comma-joined, in order."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered(spans))


_CODE = np.full(128, 1, np.uint8)
for _chars, _first in (("abcdefghijklmnopqrstuvwxyz", 2), ("0123456789", 28)):
    _CODE[[ord(c) for c in _chars]] = np.arange(_first, _first + len(_chars))
_CODE[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 38
for _i, _c in enumerate("+/_.=-:\"'"):
    _CODE[ord(_c)] = 39 + _i
_CODE[ord(" ")] = _CODE[ord("\n")] = 0


def encode(text: str, start: int, end: int) -> np.ndarray:
    """A candidate's window as character classes, the candidate at a fixed place."""
    window = text[max(0, start - BEFORE) : start].rjust(BEFORE) + text[start : min(end, start + INSIDE)].ljust(INSIDE) + text[end : end + AFTER].ljust(AFTER)
    points = np.array([ord(c) for c in window])
    return np.where(points < 128, _CODE[np.minimum(points, 127)], 1).astype(np.uint8)


class Network:
    """Embedding, one convolution, maxima over the candidate and over its context, one logistic unit."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.parts = {
            "embed": rng.normal(0, 0.4, (_CLASSES, DIMS)),
            "filters": rng.normal(0, 0.2, (WIDTH * DIMS, FILTERS)),
            "shift": np.zeros(FILTERS),
            "out": rng.normal(0, 0.2, 3 * FILTERS),
            "bias": np.zeros(1),
        }
        self.parts = {k: v.astype(np.float32) for k, v in self.parts.items()}
        self.temperature, self.threshold = 1.0, 0.5

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        p, places = self.parts, LENGTH - WIDTH + 1
        index = np.arange(places)[:, None] + np.arange(WIDTH)
        windows = x[:, index]
        z = p["embed"][windows].reshape(len(x), places, WIDTH * DIMS)
        h = np.maximum(z @ p["filters"] + p["shift"], 0)
        inner, outer = h[:, BEFORE - 2 : BEFORE + INSIDE - 2], h[:, : BEFORE - 2]
        features = np.concatenate([inner.max(1), inner.mean(1), outer.max(1)], 1)
        return features @ p["out"] + p["bias"][0], (windows, z, h, features)

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Calibrated logits of encoded candidates."""
        return np.concatenate([self._forward(x[i : i + 256])[0] for i in range(0, len(x), 256)] or [np.zeros(0)]) / self.temperature

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -35, 35)))

    def train(self, x: np.ndarray, y: np.ndarray, rounds: int = 3, rate: float = 0.01, seed: int = 11) -> None:
        """Adam steps on the logistic loss."""
        rng, p = np.random.default_rng(seed), self.parts
        first, second, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
        for _ in range(rounds):
            order = rng.permutation(len(x))
            for i in range(0, len(x), 64):
                own = order[i : i + 64]
                logit, (windows, z, h, features) = self._forward(x[own])
                error = ((1 / (1 + np.exp(-np.clip(logit, -35, 35))) - y[own]) / len(own)).astype(np.float32)
                slope = {"out": features.T @ error, "bias": np.array([error.sum()])}
                back = error[:, None] * p["out"]
                dh = np.zeros_like(h)
                inner, rows, filters = h[:, BEFORE - 2 : BEFORE + INSIDE - 2], np.arange(len(own))[:, None], np.arange(FILTERS)
                dh[rows, inner.argmax(1) + BEFORE - 2, filters] += back[:, :FILTERS]
                dh[:, BEFORE - 2 : BEFORE + INSIDE - 2] += back[:, None, FILTERS : 2 * FILTERS] / INSIDE
                dh[rows, h[:, : BEFORE - 2].argmax(1), filters] += back[:, 2 * FILTERS :]
                dh *= h > 0
                flat = dh.reshape(-1, FILTERS)
                slope["filters"], slope["shift"] = z.reshape(-1, WIDTH * DIMS).T @ flat, flat.sum(0)
                dz = (flat @ p["filters"].T).reshape(-1, DIMS)
                slope["embed"] = np.stack([np.bincount(windows.ravel(), weights=dz[:, j], minlength=_CLASSES) for j in range(DIMS)], 1)
                t += 1
                for k, g in slope.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    p[k] -= rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float = RECALL) -> None:
        """Set the temperature of least loss, then the highest threshold that keeps the recall."""
        raw = self.logits(x) * self.temperature
        grid = np.geomspace(0.25, 8, 41)
        losses = [np.mean(np.logaddexp(0, np.where(y == 1, -raw / t, raw / t))) for t in grid]
        self.temperature = float(grid[int(np.argmin(losses))])
        scores = np.sort(self.probability(x)[y == 1])
        self.threshold = float(scores[int(np.floor((1 - recall) * len(scores)))])


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def labelled(n: int = EXAMPLES, seed: int = 5) -> tuple[list[tuple[str, int, int]], np.ndarray]:
    """Generated findings: (text, start, end) and whether it is a secret, half and half."""
    rng = np.random.default_rng(seed)

    def pick(chars: str, k: int) -> str:
        return "".join(chars[i] for i in rng.integers(0, len(chars), k))

    def word() -> str:
        return "".join(pick("bcdfghlmnprst", 1) + pick("aeiou", 1) for _ in range(rng.integers(1, 5)))

    def prose(k: int) -> str:
        return " ".join(word() for _ in range(k))

    def secret() -> tuple[str, str]:
        mixed = _LOWER + _UPPER + _DIGITS
        kinds = [
            lambda: pick(mixed, rng.integers(20, 60)), lambda: pick(mixed + "+/", rng.integers(24, 64)) + "=" * rng.integers(0, 3),
            lambda: "ghp_" + pick(mixed, 36), lambda: "sk-" + pick(mixed, rng.integers(32, 48)), lambda: "xoxb-" + pick(_DIGITS, 11) + "-" + pick(mixed, 24),
            lambda: "eyJ" + pick(mixed + "_-", 30) + "." + pick(mixed + "_-", 40), lambda: "AIza" + pick(mixed + "_-", 35), lambda: pick(_LOWER + _DIGITS, rng.integers(24, 40)),
            lambda: pick(_UPPER + _DIGITS, rng.integers(20, 40)), lambda: pick("0123456789ABCDEF", rng.integers(32, 64)), lambda: pick(_LOWER + _UPPER, rng.integers(20, 48)),
            lambda: pick(mixed, rng.integers(16, 24)),
        ]
        key = kinds[rng.integers(0, len(kinds))]()
        lead = ["", "", "key: ", "auth = ", "Bearer ", 'credential="', "export KEY="][rng.integers(0, 7)]
        return lead, key

    def harmless() -> tuple[str, str]:
        kinds = [
            lambda: "-".join(word() for _ in range(rng.integers(4, 8))) + "-" + pick(_DIGITS, rng.integers(1, 5)), lambda: "www." + word() + ".com/" + "/".join(word() for _ in range(3)) + "/" + pick(_DIGITS, 3),
            lambda: "/".join(["usr", word(), word(), word() + pick(_DIGITS, 2), word() + ".py"]), lambda: "_".join(word() for _ in range(5)) + pick(_DIGITS, 2),
            lambda: f"20{pick(_DIGITS, 2)}-{pick('01', 1)}{pick(_DIGITS, 1)}-{pick('012', 1)}{pick(_DIGITS, 1)}T{pick(_DIGITS, 2)}.{pick(_DIGITS, 6)}Z", lambda: word().title() + word().title() + word().title() + word().title() + pick(_DIGITS, rng.integers(1, 3)),
            lambda: word() + "." + word() + pick(_DIGITS, 2) + "." + word() + "." + word() + ".example.org", lambda: "=" * 12 + pick(_DIGITS, 2) + word() + "=" * 12, lambda: (word() + pick(_DIGITS, 1)) * 4,
            lambda: pick("=-_.", 1) * rng.integers(16, 60), lambda: "".join(word() for _ in range(rng.integers(5, 8))), lambda: "".join(word().title() for _ in range(rng.integers(4, 7))), lambda: pick(_DIGITS, rng.integers(16, 30)),
            lambda: "/".join(word() for _ in range(rng.integers(4, 8))), lambda: "-".join(word() for _ in range(rng.integers(4, 7))), lambda: "+".join(pick(_DIGITS, 5) for _ in range(4)), lambda: "_".join(word().upper() for _ in range(4)),
            lambda: pick(_DIGITS, 18) + word(), lambda: ".".join([word(), word(), word(), "v" + pick(_DIGITS, 1), pick(_DIGITS, 2)]) + "-" + word(), lambda: (word() + word() + word() + word()).upper() + pick(_DIGITS, 2),
        ]
        lead = ["", "", "see ", "at ", "file ", "http://", "of the "][rng.integers(0, 7)]
        run = kinds[rng.integers(0, len(kinds))]()
        return lead, (run if len(run) >= LEAST_MODEL else run + word() + word())[:64]

    rows, answers = [], np.arange(n) % 2
    for y in answers:
        lead, run = secret() if y else harmless()
        run = run.ljust(LEAST_MODEL, "a") if len(run) < LEAST_MODEL else run
        before = prose(rng.integers(0, 6)) + " " + lead
        text = before + run + [" ", '"', ". ", "\n", ", "][rng.integers(0, 5)] + prose(rng.integers(0, 3))
        rows.append((text, len(before), len(before) + len(run)))
    return rows, answers.astype(np.float64)


_trained: Network | None = None


def network() -> Network:
    """The trained network; the same at every call, made once a process."""
    global _trained
    if _trained is None:
        rows, y = labelled()
        x = np.stack([encode(*row) for row in rows])
        cut = len(x) * 3 // 4
        made = Network()
        made.train(x[:cut], y[:cut])
        made.calibrate(x[cut:], y[cut:])
        _trained = made
    return _trained


def find(texts: list[str | None], model: Network) -> list[list[Span]]:
    """All spans of each text, in order; the model's candidates are judged together."""
    out, asked, places, judged = [], [], [], []
    for row, text in enumerate(texts):
        spans, others = base_spans(text) if text else ([], [])
        out.append(spans)
        judged.append({})
        for a, b in others:
            for x, y in windows(a, b):
                asked.append(encode(text, x, y))
                places.append((row, a, b))
    if asked:
        for (row, a, b), p in zip(places, model.probability(np.stack(asked)), strict=True):
            if p >= model.threshold:
                judged[row][a, b] = True
    for spans, found in zip(out, judged, strict=True):
        end = -1
        # A piece of a part that is found is found with it.
        for a, b in sorted(found, key=lambda s: (s[0], -s[1])):
            if b > end:
                spans.append(("model", a, b))
                end = b
    return [ordered(spans) for spans in out]


def _reporter(model: Network) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find(batch.column("text").to_pylist(), model)
            base = [[s for s in spans if s[0] != "model"] for spans in found]
            columns = [batch.column("doc_id")]
            columns += [pa.array([sum(s[0] == kind for s in spans) for spans in found], pa.int64()) for kind in KINDS[:3]]
            columns += [pa.array([hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base], pa.string()), pa.array([joined(spans) for spans in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return report


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, overlapping ones as one, replaced by MASK."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _redactor(model: Network) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            new = [masked(t, spans) if spans else t for t, spans in zip(texts, find(texts, model), strict=True)]
            yield batch.set_column(at, "text", pa.array(new, batch.schema.field(at).type))

    return redact


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts by base kind, the base spans' digest and all spans of every row."""
    common.prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_reporter(network()), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """The same rows with the secrets in `text` masked; n_chars, if there is one, follows the text."""
    common.prepare(docs.sparkSession)
    out = docs.mapInArrow(_redactor(network()), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9 over the whole documents table."""
    return scan(common.table(spark, sf_dir, "documents"))
