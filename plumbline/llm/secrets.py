"""Secret scans: rules, and a character convolutional network over every candidate in its context.

Candidates are all runs of ``LEAST`` or more candidate characters outside of the rules' spans,
anywhere in the whole text.  The network reads a candidate in windows that overlap, each with
the characters around it; the score of a candidate is that of its best window.  Responses of
the filters are taken once for each character of a text, and their maxima over the insides of
windows and over what stands around feed a logistic layer.

It is trained on labelled windows: those of the values that rules find are secrets, all others
are not.  Training begins in numpy with a bounded sample of the different ones of both, weighted
by how often they occur (see ``SAMPLE``).  From there on steps of gradient descent go once through
all windows of seven in ten texts: Spark sums the gradients of each step over its texts.  A window
that is on its side by ``MARGIN`` has no loss and needs no more than its score.  All windows of the
other texts are scored; by the counts of these scores they are calibrated (a logistic fit), and the
threshold is the highest that still finds ``RECALL`` of the secrets among them.
"""

from __future__ import annotations

import logging
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import ID, bytes_hash, mix, settle

log = logging.getLogger(__name__)

KINDS = ("assign", "access", "hex", "learned")
_ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW](?:[oO][rR])?[dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: what each match of the first rule has in it, in lower case, and characters that are 1 where the last rule has them
_NAMES = ("passw", "secret", "token", "apikey", "api_key")
_HEX_CLASS, _HEX_RUN = bytes(int(chr(c) in "0123456789abcdef") for c in range(256)), b"\x01" * 24
#: characters of a candidate at least, as the rule for assigned values has it
LEAST = 6
#: characters the network reads: of the candidate, and before and after it
HEAD, AROUND = 40, 16
#: from window to window of a candidate, so that 24 characters in a row stand whole in one of them
STEP = HEAD - 24
#: characters of texts that are scored at once, and that are searched for candidates at once
PART, PORTION = 1 << 15, 1 << 19
LENGTH = HEAD + 2 * AROUND
#: 1 where a candidate stands
INSIDE = np.repeat(np.array([0, 1, 0], np.uint8), [AROUND, HEAD, AROUND])
WIDTHS, FILTERS, EMBEDDING, EPOCHS = (2, 3, 5), 8, 8, 15
#: different findings of each label that training begins with
SAMPLE = 3000
#: steps that go once through all texts of training, each through its own, and their size
STEPS, RATE = 16, 0.01
#: raw score from which on a window has no loss, and steps of the raw scores that are counted
MARGIN, FINE = 4.0, 1 / 256
#: part of the findings that sets the threshold
CALIBRATION = 0.3
RECALL = 0.99


_CANDIDATE = np.zeros(256, bool)
_CANDIDATE[[ord(c) for c in "+/_=-"]] = True
_CANDIDATE[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def rule_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of what the rules find, by start and then kind."""
    return marked_spans(text)[0]


def marked_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """The spans of the rules, and (start, end) of the secrets in them, without a name before."""
    # most texts have nothing for the slower expressions to find
    lower = text.lower() if ":" in text or "=" in text else ""
    named = []
    if any(name in lower for name in _NAMES):
        named = [(m.start(), m.end(), m.start(1)) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST]
    spans = [("assign", start, end) for start, end, _ in named]
    spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if _HEX_RUN in text.encode("latin-1", "replace").translate(_HEX_CLASS):
        spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    values = [(value, end) for _, end, value in named] + [(start, end) for _, start, end in spans[len(named) :]]
    return sorted(spans, key=_order), values


def _order(span: tuple[str, int, int]) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


@dataclass
class Windows:
    """Texts one after the other, zeros between them, and the windows of their candidates."""

    data: np.ndarray  # uint8, one for each character; codes above 255 share one
    text: np.ndarray  # of each candidate
    start: np.ndarray  # of each candidate, in its text
    end: np.ndarray
    secret: np.ndarray  # of each candidate: whether it is in a rule's span
    owner: np.ndarray  # candidate of each window
    left: np.ndarray  # of each window, in data
    right: np.ndarray

    def codes(self, of: np.ndarray) -> np.ndarray:
        """What the network reads of some windows: before, inside, after."""
        left, right = self.left[of, None], self.right[of, None]
        inside = left + np.arange(HEAD)
        places = np.concatenate([left + np.arange(-AROUND, 0), np.where(inside < right, inside, 0), right + np.arange(AROUND)], axis=1)
        return self.data[places]

    def hashes(self, of: slice) -> np.ndarray:
        """Positive 63-bit hashes of what the network reads of some windows."""
        left, right = self.left[of], self.right[of]
        parts = (left - AROUND, left), (left, right), (right, right + AROUND)
        low, high = int(left[0]) - AROUND, int(right[-1]) + AROUND
        data, out = self.data[low:high], np.zeros(len(left), np.uint64)
        for start, end in parts:
            out = mix(out) + bytes_hash(data, start - low, end - low)
        return mix(out) >> np.uint64(1)


def windows(texts: list[str], spans: list[list[tuple[str, int, int]]], values: list[list[tuple[int, int]]] | None = None) -> Windows:
    """All windows of the candidates outside of ``spans``, and those of ``values`` if there are any.

    A value may have characters that other candidates have not.
    """
    gap = bytes(AROUND)
    data = np.frombuffer(gap + b"".join(t.encode("latin-1", "replace") + gap for t in texts), np.uint8)
    first = np.cumsum([AROUND, *(len(t) + AROUND for t in texts)])
    kind = _CANDIDATE[data].astype(np.int8)
    for base, of in zip(first, spans, strict=False):
        for _, start, end in of:
            kind[base + start : base + end] = 0
    if values:
        for base, of in zip(first, values, strict=False):
            for start, end in of:
                kind[base + start : base + end] = 2
    cuts = np.flatnonzero(np.diff(kind)) + 1  # data begins and ends with zeros
    start, end = cuts[:-1], cuts[1:]
    real = (kind[start] > 0) & (end - start >= LEAST)
    start, end = start[real], end[real]
    text = np.searchsorted(first, start, "right") - 1
    n = 1 + np.maximum(0, -((HEAD - (end - start)) // STEP))
    owner = np.repeat(np.arange(len(start)), n)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    # the last window ends with the candidate
    left = np.minimum(start[owner] + STEP * step, np.maximum(start, end - HEAD)[owner])
    right = np.minimum(left + HEAD, end[owner])
    return Windows(data, text, start - first[text], end - first[text], kind[start] == 2, owner, left, right)


@dataclass
class Scanner:
    params: list[np.ndarray]
    slope: float
    shift: float
    threshold: float
    #: on the findings that set the threshold, by how often they occur
    recall: float = 0.0
    precision: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of being a secret."""
        logits = np.concatenate([_forward(self.params, part)[0] for part in np.array_split(x, -(-len(x) // 256))])
        return _sigmoid(self.slope * logits + self.shift)

    @cached_property
    def singles(self) -> list[list[np.ndarray]]:
        """For each width, per offset, responses to a character."""
        return [
            [(self.params[0] @ weights[j * EMBEDDING : (j + 1) * EMBEDDING]).astype(np.float32) for j in range(width)]
            for weights, width in zip(self.params[1:], WIDTHS, strict=False)
        ]

    def tables(self, present: np.ndarray) -> list[list[np.ndarray]]:
        """For each width, per offset, responses to pairs of the characters that are present (or to the single last one)."""
        out = []
        for of in self.singles:
            single = [one[present] for one in of]
            pairs = [(a[:, None] + b[None]).reshape(-1, FILTERS) for a, b in zip(single[::2], single[1::2], strict=False)]
            out.append(pairs + single[len(pairs) * 2 :])
        return out

    def logits(self, of: Windows) -> np.ndarray:
        """Raw scores of all windows, the same as those of their codes but for rounding."""
        logits = np.zeros(len(of.left))
        # tables of the few characters that texts have stay in the cache
        there = np.bincount(of.data, minlength=256) > 0
        place, n_there = np.cumsum(there) - 1, int(there.sum())
        tables = self.tables(np.flatnonzero(there))
        at = 0
        while at < len(of.left):
            upto = np.searchsorted(of.left, of.left[at] + PART)
            base = of.left[at] - AROUND
            data = place[of.data[base : of.right[upto - 1] + AROUND]]
            left, right = of.left[at:upto] - base, of.right[at:upto] - base
            pairs, features = data[:-1] * n_there + data[1:], []
            for width, parts in zip(WIDTHS, tables, strict=True):
                n = len(data) - width + 1
                response = np.take(parts[0], pairs[:n], axis=0)
                for k, part in enumerate(parts[1:], 1):
                    response += np.take(part, (pairs if 2 * k + 1 < width else data)[2 * k : 2 * k + n], axis=0)
                levels = [response]
                while 2 << len(levels) - 1 <= HEAD - width + 1:
                    shift = 1 << len(levels) - 1
                    levels.append(np.maximum(levels[-1][:-shift], levels[-1][shift:]))
                features.append(_most(levels, left, right - width + 1))
                features.append(np.maximum(_most(levels, left - AROUND, left), _most(levels, right, right + AROUND - width + 1)))
            z = np.concatenate(features, axis=1) + np.concatenate([b for b in self.params[4:7] for _ in range(2)])
            logits[at:upto] = np.maximum(z, 0) @ self.params[7] + self.params[8][0]
            at = upto
        return logits

    def score_windows(self, of: Windows) -> np.ndarray:
        """Scores of all windows, the same as those of their codes but for rounding."""
        return _sigmoid(self.slope * self.logits(of) + self.shift)


def _most(levels: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Maximum of the responses in each range; level k has those of 2**k from each place on."""
    level = np.frexp(end - start)[1] - 1
    kinds = np.flatnonzero(np.bincount(level))
    if len(kinds) == 1:
        return _pair(levels[kinds[0]], start, end, 1 << kinds[0])
    out = np.empty((len(start), FILTERS), np.float32)
    for k in kinds:
        rows = np.flatnonzero(level == k)
        out[rows] = _pair(levels[k], start[rows], end[rows], 1 << k)
    return out


def _pair(level: np.ndarray, start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    return np.maximum(np.take(level, start, axis=0), np.take(level, end - size, axis=0))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _forward(params: list[np.ndarray], x: np.ndarray):
    emb = params[0][x.astype(np.intp)]
    columns, best, features = [], [], []
    for k, width in enumerate(WIDTHS):
        views = np.lib.stride_tricks.sliding_window_view(emb, width, axis=1)
        cols = views.transpose(0, 1, 3, 2).reshape(len(x), LENGTH - width + 1, width * EMBEDDING)
        response = cols @ params[1 + k]
        place = np.arange(LENGTH - width + 1)
        # a short candidate leaves zeros behind it, which are in no window of a text
        inside = (place >= AROUND) & (place <= AROUND + HEAD - width) & (x[:, width - 1 :] != 0)
        around = np.broadcast_to((place < AROUND) | (place >= AROUND + HEAD), inside.shape)
        columns.append(cols)
        for of in (inside, around):
            top = np.where(of[:, :, None], response, -np.inf).argmax(axis=1)
            best.append(top)
            features.append(np.take_along_axis(response, top[:, None, :], 1)[:, 0] + params[4 + k])
    z = np.concatenate(features, axis=1)
    return np.maximum(z, 0) @ params[7] + params[8][0], z, columns, best


def _gradients(params: list[np.ndarray], x: np.ndarray, g_out: np.ndarray, z: np.ndarray, columns: list, best: list) -> list[np.ndarray]:
    """Gradients of all parameters from those of the logits and what ``_forward`` gave beside them."""
    grads = [np.zeros_like(q) for q in params]
    grads[7], grads[8] = np.maximum(z, 0).T @ g_out, np.array([g_out.sum()])
    back = g_out[:, None] * params[7] * (z > 0)
    for j, top in enumerate(best):
        k, width = j // 2, WIDTHS[j // 2]
        g = back[:, j * FILTERS : (j + 1) * FILTERS]
        grads[4 + k] += g.sum(axis=0)
        grads[1 + k] += np.einsum("bf,bfe->ef", g, columns[k][np.arange(len(x))[:, None], top])
        to_emb = (g[:, :, None] * params[1 + k].T[None]).reshape(len(x), FILTERS, width, EMBEDDING)
        np.add.at(grads[0], x[np.arange(len(x))[:, None, None], top[:, :, None] + np.arange(width)], to_emb)
    return grads


def in_runs(rng: np.random.Generator, x: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Each candidate, or as much of it as some window holds whole, in a window of a long run of another one."""
    out = np.empty_like(x)
    for k, (row, other) in enumerate(zip(x[:, AROUND : AROUND + HEAD], others[:, AROUND : AROUND + HEAD], strict=True)):
        body = row[row != 0]
        kept = min(len(body), HEAD - STEP)
        first, at = rng.integers(0, len(body) - kept + 1), rng.integers(0, HEAD - kept + 1)
        run = np.append(other[other != 0], ord("/"))
        out[k] = np.resize(np.roll(run, rng.integers(0, len(run))), LENGTH)
        out[k, AROUND + at : AROUND + at + kept] = body[first : first + kept]
    return out


def train(x: np.ndarray, y: np.ndarray, counts: np.ndarray | None = None, seed: int = 11) -> Scanner:
    """Fit, calibrate and set the threshold; ``y`` is 1 for secrets, ``counts`` how often each occurs."""
    rng = np.random.default_rng(seed)
    counts = np.ones(len(x)) if counts is None else counts
    order = rng.permutation(len(x))
    n_held = max(1, int(CALIBRATION * len(x)))
    held, seen = order[:n_held], order[n_held:]
    if len(set(y[seen])) < 2 or not y[held].any():
        held = seen = order
    params = [rng.normal(0, 0.5, (256, EMBEDDING))]
    params += [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)) for w in WIDTHS]
    params += [np.zeros(FILTERS) for _ in WIDTHS]
    params += [rng.normal(0, 0.3, 2 * len(WIDTHS) * FILTERS), np.zeros(1)]
    moment, speed, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    others = seen[y[seen] == 0]
    n_label = np.bincount(y[seen], minlength=2)
    weight = len(seen) / (2 * np.maximum(1, n_label))
    # findings of a label are drawn by how often they occur
    drawn = np.cumsum(counts[seen] * (n_label / np.maximum(1, np.bincount(y[seen], counts[seen], minlength=2)))[y[seen]])
    for _ in range(EPOCHS):
        for at in range(0, len(seen), 64):
            rows = seen[np.minimum(np.searchsorted(drawn, rng.random(64) * drawn[-1], "right"), len(seen) - 1)]
            xb, yb = x[rows].astype(np.intp), y[rows]
            way = rng.integers(0, 3, 64)
            xb[way == 1] *= INSIDE
            if len(others):
                xb[way == 2] = in_runs(rng, xb[way == 2], x[rng.choice(others, int((way == 2).sum()))])
            logits, *inner = _forward(params, xb)
            grads = _gradients(params, xb, (_sigmoid(logits) - yb) * weight[yb] / len(rows), *inner)
            t += 1
            for q, g, m, v in zip(params, grads, moment, speed, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    logits, labels, n = _forward(params, x[held])[0], y[held], counts[held]
    slope, shift = calibrate(logits, labels, n)
    scanner = Scanner(params, slope, shift, 0.5)
    # the highest threshold that keeps the recall, whatever precision that costs: with and without what
    # stands around, as that may be what names a secret to the rules, and behind the head of a longer run
    named = np.flatnonzero(labels == 1)
    ways = [x[held][named], x[held][named] * INSIDE]
    if len(others):
        ways.append(in_runs(rng, ways[0], x[rng.choice(others, len(named))]))
    limits = []
    for way in ways if len(named) else []:
        scores = scanner.score(way)
        order = np.argsort(scores)
        missed = np.cumsum(n[named][order])
        limits.append(float(scores[order][np.searchsorted(missed, (1 - RECALL) * missed[-1], "right")]))
    scanner.threshold = min(limits, default=0.5)
    taken = scanner.score(x[held]) >= scanner.threshold
    right, wrong = n[taken & (labels == 1)].sum(), n[taken & (labels == 0)].sum()
    scanner.recall = float(right / max(1, n[labels == 1].sum()))
    scanner.precision = float(right / max(1, right + wrong))
    _warn(scanner)
    return scanner


def _warn(scanner: Scanner) -> None:
    if scanner.precision < 0.5:
        log.warning("secret scan: keeping %.0f %% recall leaves a precision of %.3f on held-out findings", 100 * RECALL, scanner.precision)


def calibrate(logits: np.ndarray, labels: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit to the scores, by gradient steps on smoothed labels."""
    n1, n0 = n[labels == 1].sum(), n[labels == 0].sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(1.0, float(np.abs(logits).max()))
    z, slope, shift = logits / scale, 1.0, 0.0
    for _ in range(500):
        gap = _sigmoid(slope * z + shift) - target
        slope, shift = slope - 5 * float(np.average(gap * z, weights=n)), shift - 5 * float(np.average(gap, weights=n))
    return max(slope, 1e-3) / scale, shift


# --------------------------------------------------------------------- tables


class Smallest:
    """The ``SAMPLE`` findings of smallest hash of each label, with their exact counts.

    A finding that is among them in the end is so at any time before, so none of its copies
    is missed, and what leaves never comes back.
    """

    def __init__(self) -> None:
        self.kept: tuple[dict[int, list], ...] = ({}, {})
        self.limit = [np.uint64((1 << 64) - 1)] * 2

    def add(self, of: Windows, at: int) -> None:
        """Windows from the place ``at`` on, as many as are taken at once."""
        span = slice(at, at + 4096)
        labels, hashes = of.secret[of.owner[span]], of.hashes(span)
        for label, kept in enumerate(self.kept):
            rows = np.flatnonzero((labels == label) & (hashes <= self.limit[label]))
            keys, first, counts = np.unique(hashes[rows], return_index=True, return_counts=True)
            for key, codes, n in zip(keys.tolist(), of.codes(at + rows[first]), counts.tolist(), strict=True):
                kept.setdefault(key, [codes.tobytes(), 0])[1] += n
            if len(kept) > 2 * SAMPLE:
                self.prune(label)

    def prune(self, label: int) -> None:
        kept = self.kept[label]
        for key in sorted(kept)[SAMPLE:]:
            del kept[key]
        if len(kept) == SAMPLE:
            self.limit[label] = np.uint64(max(kept))

    def batch(self) -> pa.RecordBatch:
        rows = []
        for label, kept in enumerate(self.kept):
            self.prune(label)
            rows += [(label, key, codes, n) for key, (codes, n) in kept.items()]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        types = pa.int64(), pa.int64(), pa.binary(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["label", "hash", "codes", "n"])


def findings(docs: DataFrame) -> DataFrame:
    """label, codes and n (how often they occur) of the training sample.

    Every window of every candidate is labelled; of each label the ``SAMPLE`` different findings
    with the smallest hashes stay.  Each task keeps no more than it may add to them.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smallest = Smallest()
        for batch in batches:
            for texts in portions(batch.column(0).to_pylist()):
                of = _labelled(texts)
                for at in range(0, len(of.owner), 4096):
                    smallest.add(of, at)
        yield smallest.batch()

    texts = docs.filter(F.col("text").isNotNull()).select("text")
    parts = settle(texts.mapInArrow(label, "label long, hash long, codes binary, n long"))
    whole = parts.groupBy("label", "hash", "codes").agg(F.sum("n").alias("n"))
    first, second = (whole.filter(F.col("label") == k).orderBy("hash", "codes").limit(SAMPLE) for k in (0, 1))
    return first.unionByName(second).select("label", "codes", "n")


def _labelled(texts: list[str]) -> Windows:
    found = [marked_spans(t) for t in texts]
    return windows(texts, [spans for spans, _ in found], [values for _, values in found])


def other_ways(texts: list[str], of: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, label and way (see ``train``) of the secrets, and of as many other windows in ways 1 and 2.

    Others are drawn from the text of the secret, so that they depend on nothing but this text.
    """
    blank = np.zeros((0, LENGTH), np.uint8)
    x, label, way = [blank], [], []
    secret = of.secret[of.owner]
    text = of.text[of.owner]
    for k in np.unique(text[secret]).tolist():
        first, last = np.searchsorted(text, [k, k + 1])
        rows, rest = (first + np.flatnonzero(secret[first:last] == v) for v in (True, False))
        rng = np.random.default_rng(crc32(texts[k].encode()))
        named = of.codes(rows)
        made = [(1, 0, named), (1, 1, named * INSIDE)]
        if len(rest):
            drawn, *others = (of.codes(rng.choice(rest, len(rows))) for _ in range(3))
            made += [(1, 2, in_runs(rng, named, others[0])), (0, 1, drawn * INSIDE), (0, 2, in_runs(rng, drawn, others[1]))]
        x += [codes for *_, codes in made]
        label += [np.full(len(rows), v) for v, *_ in made]
        way += [np.full(len(rows), v) for _, v, _ in made]
    none = [np.zeros(0, int)]
    return np.concatenate(x), np.concatenate(none + label), np.concatenate(none + way)


def gradient_sums(texts: list[str], network: Scanner) -> np.ndarray:
    """Sums of the gradients over all windows of the texts, and last how many these are.

    One row for all windows that are no secrets, one for those that are made of them, one for secrets.
    The loss of a window is how much its score lacks of ``MARGIN`` on its label's side of 0.
    """
    out = np.zeros((3, sum(p.size for p in network.params) + 1))

    def add(row: int, x: np.ndarray, sign: int) -> None:
        for at in range(0, len(x), 256):
            codes = x[at : at + 256].astype(np.intp)
            logits, *inner = _forward(network.params, codes)
            grads = _gradients(network.params, codes, -sign * (sign * logits < MARGIN).astype(float), *inner)
            out[row, :-1] += np.concatenate([g.ravel() for g in grads])

    of = _labelled(texts)
    if not len(of.owner):
        return out
    plain = ~of.secret[of.owner]
    # all others have no loss, and so no gradient
    lossy = np.flatnonzero(plain & (network.logits(of) > -MARGIN - 1e-4))
    for at in range(0, len(lossy), 4096):
        add(0, of.codes(lossy[at : at + 4096]), -1)
    x, label, _ = other_ways(texts, of)
    add(1, x[label == 0], -1)
    add(2, x[label == 1], 1)
    out[:, -1] = plain.sum(), (label == 0).sum(), (label == 1).sum()
    return out


class Descent:
    """Steps of Adam; of each step's gradient secrets make up one half, in the three ways as in ``train``."""

    def __init__(self, network: Scanner) -> None:
        self.network, self.t = network, 0
        size = sum(p.size for p in network.params)
        self.moment, self.speed = np.zeros(size), np.zeros(size)

    def step(self, sums: np.ndarray) -> None:
        means = sums[:, :-1] / np.maximum(1, sums[:, -1:])
        g = np.array([1 / 6, 1 / 3, 1 / 2]) @ means
        self.t += 1
        self.moment += 0.1 * (g - self.moment)
        self.speed += 0.01 * (g * g - self.speed)
        change = RATE * (self.moment / (1 - 0.9**self.t)) / (np.sqrt(self.speed / (1 - 0.99**self.t)) + 1e-6)
        cuts = np.cumsum([p.size for p in self.network.params])[:-1]
        params = [p - c.reshape(p.shape) for p, c in zip(self.network.params, np.split(change, cuts), strict=True)]
        self.network = Scanner(params, 1.0, 0.0, 0.5)


def score_counts(texts: list[str], network: Scanner) -> dict[tuple[int, int, int], int]:
    """How many windows of each label and way have which raw score, in steps of ``FINE``."""
    of = _labelled(texts)
    if not len(of.owner):
        return {}
    x, label, way = other_ways(texts, of)
    named = x[label == 1]
    raw = [_forward(network.params, part)[0] for part in np.array_split(named, -(-len(named) // 256))] if len(named) else []
    plain = network.logits(of)[~of.secret[of.owner]]
    scores = np.concatenate([plain, *raw])
    bins = np.floor(np.clip(scores, -100, 100) / FINE).astype(np.int64)
    kinds = np.concatenate([np.zeros(len(plain), int), 3 + way[label == 1]])
    found, n = np.unique(kinds * (1 << 20) + bins + (1 << 19), return_counts=True)
    kind, bins = np.divmod(found, 1 << 20)
    return dict(zip(zip((kind // 3).tolist(), (kind % 3).tolist(), (bins - (1 << 19)).tolist(), strict=True), n.tolist(), strict=True))


def settle_threshold(network: Scanner, counts: dict[tuple[int, int, int], int]) -> Scanner:
    """Calibrate and set the threshold on all windows that were counted (see ``score_counts``)."""
    keys = np.array(sorted(counts))
    n = np.array([counts[tuple(k)] for k in keys.tolist()], float)
    label, way, bins = keys.T
    scores = bins * FINE
    real = way == 0
    slope, shift = calibrate(scores[real], label[real], n[real])
    # the highest that keeps the recall in all ways, see ``train``
    limits = []
    for k in np.unique(way[label == 1]):
        rows = np.flatnonzero((label == 1) & (way == k))
        missed = np.cumsum(n[rows])
        limits.append(scores[rows[np.searchsorted(missed, (1 - RECALL) * missed[-1], "right")]])
    limit = min(limits)
    right, wrong = (n[real & (label == v) & (scores >= limit)].sum() for v in (1, 0))
    scanner = Scanner(network.params, slope, shift, float(_sigmoid(slope * limit + shift)))
    scanner.recall, scanner.precision = float(right / n[real & (label == 1)].sum()), float(right / (right + wrong))
    _warn(scanner)
    return scanner


def fit(docs: DataFrame) -> Scanner | None:
    """Scanner trained on all windows of ``docs``; None where the rules find nothing.

    The sample of ``findings`` only gives the network that the steps over all windows begin with.
    """
    place = F.crc32("text") % (10 * STEPS)
    whole = docs.filter(F.col("text").isNotNull()).select("text", (place % 10).alias("tenth"), F.floor(place / 10).alias("step"))
    held = F.col("tenth") < round(10 * CALIBRATION)
    # folds of equal texts; where one has no secrets, all serve for both
    for seen, apart in (whole.filter(~held), whole.filter(held)), (whole, whole):
        rows = sorted(findings(seen).collect(), key=lambda r: (r.label, bytes(r.codes)))  # bounded sample
        if any(r.label == 1 for r in rows):
            break
    else:
        return None
    x = np.frombuffer(b"".join(bytes(r.codes) for r in rows), np.uint8).reshape(len(rows), LENGTH)
    descent = Descent(train(x, np.array([r.label for r in rows]), np.array([r.n for r in rows], float)))
    for step in range(STEPS):
        descent.step(_sums_of(seen.filter(F.col("step") == step), descent.network))
    counts = _counts_of(apart, descent.network)
    if not any(label for label, *_ in counts):
        counts = _counts_of(whole, descent.network)
    return settle_threshold(descent.network, counts)


def _sums_of(docs: DataFrame, network: Scanner) -> np.ndarray:
    """``gradient_sums`` of a whole table."""
    sent = docs.sparkSession.sparkContext.broadcast(network)
    blank = gradient_sums([], network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = blank.copy()
        for batch in batches:
            for texts in portions(batch.column(0).to_pylist()):
                sums += gradient_sums(texts, sent.value)
        places = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(sums.flat[places])], names=["place", "value"])

    parts = docs.select("text").mapInArrow(run, "place long, value double")
    out = blank.copy()
    for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():  # as many as parameters
        out.flat[r.place] = r.value
    return out


def _counts_of(docs: DataFrame, network: Scanner) -> dict[tuple[int, int, int], int]:
    """``score_counts`` of a whole table."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for texts in portions(batch.column(0).to_pylist()):
                counts.update(score_counts(texts, sent.value))
        rows = [(*key, n) for key, n in counts.items()]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["label", "way", "score", "n"])

    parts = docs.select("text").mapInArrow(run, "label long, way long, score long, n long")
    whole = parts.groupBy("label", "way", "score").agg(F.sum("n").alias("n"))
    return {(r.label, r.way, r.score): r.n for r in whole.collect()}  # as many as different scores


def portions(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of about half a million characters."""
    part: list[str] = []
    held = 0
    for text in texts:
        if part and held + len(text) > PORTION:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text)
    if part:
        yield part


def all_spans(texts: list[str], scanner: Scanner | None) -> list[tuple[list, list]]:
    """For each text the rules' spans, and the further spans that the network adds."""
    out: list[tuple[list, list]] = []
    for part in portions(texts):
        base = [rule_spans(t) for t in part]
        more: list[list] = [[] for _ in part]
        if scanner:
            of = windows(part, base)
            if len(of.owner):
                best = np.maximum.reduceat(scanner.score_windows(of), np.searchsorted(of.owner, np.arange(len(of.start))))
                # the sums of training are longer numbers
                for k in np.flatnonzero(best >= scanner.threshold - 1e-6).tolist():
                    more[of.text[k]].append(("learned", int(of.start[k]), int(of.end[k])))
        out += zip(base, more, strict=True)
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, scanner: Scanner | None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_learned of every row.

    Spans are code points, the end exclusive.  A null text is an empty one and has no spans.
    Repeated rows get equal answers; an empty table gives no rows; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(scanner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = all_spans([t or "" for t in batch.column(1).to_pylist()], sent.value)
            counts = [[sum(s[0] == kind for s in base) for base, _ in found] for kind in KINDS[:3]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([sha256(joined(base).encode()).hexdigest() for base, _ in found]),
                    pa.array([joined(sorted(base + more, key=_order)) for base, more in found]),
                    pa.array([len(more) for _, more in found], pa.int64()),
                ],
                names=[ID, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_learned"],
            )

    shape = f"{ID} {dict(docs.dtypes)[ID]}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_learned long"
    return docs.select(ID, "text").mapInArrow(run, shape)


def redact(docs: DataFrame, scanner: Scanner | None, mark: str = "[secret]", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark`` (overlapping spans by one)."""
    sent = docs.sparkSession.sparkContext.broadcast(scanner)
    index = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(index).to_pylist()
            out = []
            for text, (base, more) in zip(texts, all_spans([t or "" for t in texts], sent.value), strict=True):
                parts, at = [], 0
                for _, start, end in sorted(base + more, key=_order):
                    if start >= at:
                        parts += [text[at:start], mark]
                    at = max(at, end)
                out.append(text if text is None else "".join([*parts, text[at:]]))
            columns = list(batch.columns)
            columns[index] = pa.array(out, columns[index].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    clean = docs.mapInArrow(run, shape)
    if n_chars in docs.columns:
        clean = clean.withColumn(n_chars, F.length("text").cast(dict(docs.dtypes)[n_chars]))
    return clean
