"""Language ID with a byte convolutional network, trained in numpy on labelled text.

A text is read as windows of ``WINDOW`` bytes.  Byte embeddings pass through filters of
several widths, the strongest response of each filter in the window goes through a rectifier
to a softmax layer.  A text's prediction is the mean over all its windows.

Training uses a bounded sample of labelled documents (``PER_LANGUAGE`` in expectation for each
language, ``WINDOWS_PER_DOC`` windows of each); prediction reads every byte of every text.
Trained filters are turned into tables over pairs of bytes, so prediction is lookups and maxima.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import ID, text_buffers

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
#: bounds of the training sample
PER_LANGUAGE = 400
WINDOWS_PER_DOC = 4
EPOCHS = 12
FOLDS = 5
UNDECIDED = "und"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def text_windows(data: np.ndarray) -> np.ndarray:
    """All windows of a text; the last one ends with the text, a shorter text is padded with spaces."""
    n = len(data)
    if n <= WINDOW:
        out = np.full((1, WINDOW), 32, np.uint8)
        out[0, :n] = data
        return out
    starts = np.append(np.arange(0, n - WINDOW, WINDOW), n - WINDOW)
    return data[starts[:, None] + np.arange(WINDOW)]


# ------------------------------------------------------------------- network


@dataclass
class Network:
    labels: list[str]
    embedding: np.ndarray  # 256, EMBEDDING
    filters: list[np.ndarray]  # per width: width * EMBEDDING, FILTERS
    biases: list[np.ndarray]
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """For each width, per offset, responses to pairs of bytes (or to the single last byte)."""
        out = []
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            single = [(self.embedding @ weights[j * EMBEDDING : (j + 1) * EMBEDDING]).T.astype(np.float32) for j in range(width)]
            parts = []
            for j in range(0, width, 2):
                if j + 1 < width:
                    pair = single[j][:, :, None] + single[j + 1][:, None, :]
                    parts.append(np.ascontiguousarray(pair.reshape(FILTERS, 65536)))
                else:
                    parts.append(single[j])
            out.append(parts)
        return out


def predict(net: Network, tables: list[list[np.ndarray]], x: np.ndarray) -> np.ndarray:
    """Class probabilities of windows."""
    n = len(x)
    single = x.astype(np.intp)
    pairs = (single[:, :-1] << 8) | single[:, 1:]
    features = np.empty((n, len(WIDTHS) * FILTERS), np.float32)
    column = 0
    for width, parts, bias in zip(WIDTHS, tables, net.biases, strict=True):
        length = WINDOW - width + 1
        keys = [np.ascontiguousarray((pairs if 2 * k + 1 < width else single)[:, 2 * k : 2 * k + length]) for k in range(len(parts))]
        value, more = np.empty((n, length), np.float32), np.empty((n, length), np.float32)
        for f in range(FILTERS):
            np.take(parts[0][f], keys[0], out=value, mode="clip")
            for part, key in zip(parts[1:], keys[1:], strict=True):
                np.take(part[f], key, out=more, mode="clip")
                value += more
            features[:, column] = value.max(axis=1) + bias[f]
            column += 1
    np.maximum(features, 0, out=features)
    return _softmax(features @ net.dense + net.dense_bias)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, labels: list[str], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Fit the network by Adam; ``y`` holds indexes of ``labels``."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.5, (256, EMBEDDING))]
    params += [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)) for w in WIDTHS]
    params += [np.zeros(FILTERS) for _ in WIDTHS]
    params += [rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(labels))), np.zeros(len(labels))]
    moment, speed, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    n_widths = len(WIDTHS)
    # rare languages weigh as much as common ones
    weight = len(y) / (len(labels) * np.maximum(1, np.bincount(y, minlength=len(labels))))
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), 64):
            rows = order[at : at + 64]
            xb, yb = x[rows].astype(np.intp), y[rows]
            emb = params[0][xb]
            columns, best, features = [], [], []
            for k, width in enumerate(WIDTHS):
                views = np.lib.stride_tricks.sliding_window_view(emb, width, axis=1)  # b, l, e, w
                cols = views.transpose(0, 1, 3, 2).reshape(len(rows), WINDOW - width + 1, width * EMBEDDING)
                response = cols @ params[1 + k]
                top = response.argmax(axis=1)
                columns.append(cols)
                best.append(top)
                features.append(np.take_along_axis(response, top[:, None, :], 1)[:, 0] + params[1 + n_widths + k])
            z = np.concatenate(features, axis=1)
            hidden = np.maximum(z, 0)
            p = _softmax(hidden @ params[-2] + params[-1])
            p[np.arange(len(rows)), yb] -= 1
            p *= weight[yb][:, None] / len(rows)
            grads = [np.zeros_like(q) for q in params]
            grads[-2], grads[-1] = hidden.T @ p, p.sum(axis=0)
            back = (p @ params[-2].T) * (z > 0)
            for k, width in enumerate(WIDTHS):
                g = back[:, k * FILTERS : (k + 1) * FILTERS]
                grads[1 + n_widths + k] = g.sum(axis=0)
                picked = columns[k][np.arange(len(rows))[:, None], best[k]]  # b, f, w * e
                grads[1 + k] = np.einsum("bf,bfe->ef", g, picked)
                to_emb = (g[:, :, None] * params[1 + k].T[None]).reshape(len(rows), FILTERS, width, EMBEDDING)
                places = best[k][:, :, None] + np.arange(width)
                np.add.at(grads[0], xb[np.arange(len(rows))[:, None, None], places], to_emb)
            t += 1
            for q, g, m, v in zip(params, grads, moment, speed, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    filters, biases = params[1 : 1 + n_widths], params[1 + n_widths : 1 + 2 * n_widths]
    return Network(labels, params[0], filters, biases, params[-2].astype(np.float32), params[-1].astype(np.float32))


# -------------------------------------------------------------------- tables


def held_out(docs_id=ID):
    """Documents that training must not see."""
    return F.coalesce(F.crc32(F.col(docs_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_windows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """label, window: the bounded sample; ids are hashed to choose it, so it is stable."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out() & F.col(ID).isNotNull())
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    share = F.pmod(F.xxhash64(F.lit(17), F.col(ID)), F.lit(1 << 30)) / float(1 << 30)
    bound = F.create_map(*[F.lit(v) for of in counts.items() for v in (of[0], per_language / of[1])]) if counts else F.lit(None).cast("map<string,double>")
    sample = labelled.filter(share < F.element_at(bound, F.col("lang"))).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            labels, windows = [], []
            for lang, a, b in zip(batch.column(0).to_pylist(), offsets[:-1], offsets[1:], strict=True):
                if b > a:
                    of = text_windows(data[a:b])
                    for k in np.unique(np.linspace(0, len(of) - 1, WINDOWS_PER_DOC).astype(int)):
                        labels.append(lang)
                        windows.append(of[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(windows, pa.binary())], names=["label", "window"])

    return sample.mapInArrow(run, "label string, window binary")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """Network for the languages of ``docs``; None where nothing is labelled."""
    rows = sorted(training_windows(docs, per_language).collect(), key=lambda r: (r.label, bytes(r.window)))  # bounded sample
    if not rows:
        return None
    labels = sorted({r.label for r in rows})
    x = np.frombuffer(b"".join(bytes(r.window) for r in rows), np.uint8).reshape(len(rows), WINDOW)
    return train(x, np.array([labels.index(r.label) for r in rows]), labels)


def predict_languages(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced).

    ``und`` with score 0 stands for a null text, one without a letter, and every text where no
    language could be learned.  Equal texts get equal answers; an empty table gives no rows.
    """
    docs = docs.drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast((net, net.tables() if net else None))
    index = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, tables = sent.value
        for batch in batches:
            data, offsets = text_buffers(batch.column(index))
            names, scores = [UNDECIDED] * batch.num_rows, np.zeros(batch.num_rows)
            rows, windows, held = [], [], 0

            def flush():
                if rows:
                    x = np.concatenate(windows)
                    p = np.concatenate([predict(net, tables, w) for w in np.array_split(x, -(-len(x) // 512))])
                    owner = np.repeat([r for r, _ in rows], [n for _, n in rows])
                    total = np.zeros((batch.num_rows, len(net.labels)))
                    np.add.at(total, owner, p)
                    for r, n in rows:
                        k = int(total[r].argmax())
                        names[r], scores[r] = net.labels[k], min(1.0, float(total[r, k] / n))
                    rows.clear()
                    windows.clear()

            for r, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                part = data[a:b]
                if net is None or not (_LETTER[part].any() or any(map(str.isalpha, bytes(part).decode("utf-8", "replace")))):
                    continue
                windows.append(text_windows(part))
                rows.append((r, len(windows[-1])))
                held += len(windows[-1])
                if held > 4096:
                    flush()
                    held = 0
            flush()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names), pa.array(scores)], names=[*batch.schema.names, "lang_pred", "score"])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{shape}, lang_pred string, score double")
