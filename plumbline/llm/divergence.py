"""Quality rules by distribution divergence.

Two histograms describe a text: its characters by class, and its words by the common words of
a language (all others share one bin).  References are the same histograms over all texts of a
language that pass the base rules; a word is common if at least ``COMMON`` of the language's
words are it, so a list holds at most ``1 / COMMON`` words however large the corpus.  Every
language is a reference, however little text it has: its shares are mixed with those of all
languages as if ``PRIOR`` more words had been seen, so one with a handful of texts is near the mixture.
A text fails if, for every language, its Jensen-Shannon distance (base 2) exceeds the limit for
characters or for words.

Short histograms are far from any reference by chance, by an amount that falls with the root of
their length.  So texts below ``FULL_LENGTH`` words are guarded: their limits are wider by that much.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import ID, Slice, grams, settle, slices

#: fixed values of the contract
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 50, 50
#: share of a language's words from which a word is common
COMMON = 0.001
#: words, and characters for each of them, of all languages that every language is taken to have seen besides its own
PRIOR, PRIOR_CHARACTERS = 100, 6
#: languages that serve as references, those with the most words; the others only count for the mixture
LANGUAGES = 100
#: distances beyond which a text of ``FULL_LENGTH`` words or more is unlike a language
CHARACTER_LIMIT, WORD_LIMIT, FULL_LENGTH = 0.30, 0.52, 200
#: how much wider the limits of shorter texts are, for each 1 / root of their length
CHARACTER_GUARD, WORD_GUARD = 0.2, 0.2

CLASSES = ("lower", "upper", "digit", "space", "sentence mark", "other mark", "symbol", "letter beyond ASCII", "control")


def _class_table() -> np.ndarray:
    out = np.full(256, 5, np.int64)
    for c in range(256):
        ch = chr(c)
        if c >= 0xC0:
            out[c] = 7  # leads a character beyond ASCII
        elif c >= 0x80:
            out[c] = -1  # goes on with one
        elif ch in SYMBOLS:
            out[c] = 6
        elif c in (9, 10, 11, 12, 13, 32):
            out[c] = 3
        elif c < 32 or c == 127:
            out[c] = 8
        elif ch.islower():
            out[c] = 0
        elif ch.isupper():
            out[c] = 1
        elif ch.isdigit():
            out[c] = 2
        elif ch in ".,;:!?'\"":
            out[c] = 4
    return out


_CLASS = _class_table()
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _per_row(mask_sum: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return mask_sum[hi] - mask_sum[lo]


def _running(mask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def base_counts(part: Slice, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """Columns of the base rules for the rows of a slice."""
    lead = _running((part.data & 0xC0) != 0x80)
    chars = _running(lead[part.ends] - lead[part.starts])
    return {
        "n_words": np.diff(part.words),
        "word_chars": _per_row(chars, part.words[:-1], part.words[1:]),
        "n_symbols": _per_row(_running(_IS_SYMBOL[part.data]), part.bounds[:-1], part.bounds[1:]),
        "n_dup_lines": _repeated_lines(part),
        "n_repeat_words": _repeated_words(part, hashes),
    }


def _repeated_lines(part: Slice) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    breaks = part.data == 10
    starts = np.unique(np.concatenate([part.bounds[:-1], np.flatnonzero(breaks) + 1]))
    starts = starts[starts < len(part.data)]
    ends = np.append(starts[1:], len(part.data))
    ends = ends - ((ends > starts) & breaks[np.maximum(ends - 1, 0)])  # without the break itself
    row = np.searchsorted(part.bounds, starts, "right") - 1
    words_before = np.searchsorted(part.starts, np.concatenate([starts, ends]))
    wordy = words_before[: len(starts)] < words_before[len(starts) :]
    starts, ends, row = starts[wordy], ends[wordy], row[wordy]
    out = np.zeros(part.rows, np.int64)
    raw = part.data.tobytes()
    of_row = np.searchsorted(row, np.arange(part.rows + 1))
    for r in np.flatnonzero(np.diff(of_row) > 1):
        lines = [raw[a:b] for a, b in zip(starts[of_row[r] : of_row[r + 1]].tolist(), ends[of_row[r] : of_row[r + 1]].tolist(), strict=True)]
        out[r] = len(lines) - len(set(lines))
    return out


def _repeated_words(part: Slice, hashes: np.ndarray) -> np.ndarray:
    """Words inside 3-word windows that their text holds twice or more."""
    three, inside = grams(hashes, part.row, 3)
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(part.rows, np.int64)
    # a window and its row as one number, so that one sort finds repetitions
    key = three[at] ^ (part.row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    equal = key[order][1:] == key[order][:-1]
    twice = np.append(equal, False) | np.append(False, equal)
    covered = np.zeros(len(hashes) + 2, bool)
    for j in range(3):
        covered[at[order[twice]] + j] = True
    return np.bincount(part.row[covered[: len(hashes)]], minlength=part.rows)


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED * counts["n_words"])


def class_counts(part: Slice) -> np.ndarray:
    """Characters of each class per row."""
    kinds = _CLASS[part.data]
    rows = np.repeat(np.arange(part.rows), np.diff(part.bounds))
    seen = kinds >= 0
    n = len(CLASSES)
    return np.bincount(rows[seen] * n + kinds[seen], minlength=part.rows * n).reshape(part.rows, n)


# ----------------------------------------------------------------- references


@dataclass
class References:
    languages: list[str]
    classes: np.ndarray  # languages, classes: shares
    words: np.ndarray  # sorted hashes of all common words
    shares: np.ndarray  # languages, words + 1: shares; the last bin is all other words


def reference_counts(docs: DataFrame) -> DataFrame:
    """lang, is_word, key, n: counts over all texts that have a language and pass the base rules."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, codes = np.unique(np.array(batch.column(0).to_pylist(), object).astype(str), return_inverse=True)
            words, langs, classes = [], [], np.zeros((len(names), len(CLASSES)), np.int64)
            for part in slices(batch.column(1)):
                hashes = part.hashes()
                lang = codes[part.first : part.first + part.rows]
                good = ~base_failed(base_counts(part, hashes))
                np.add.at(classes, lang[good], class_counts(part)[good])
                words.append(hashes[good[part.row]])
                langs.append(lang[part.row][good[part.row]])
            words, langs = np.concatenate(words), np.concatenate(langs)
            out = []
            for k, name in enumerate(names):
                keys, n = np.unique(words[langs == k], return_counts=True)
                keys = np.concatenate([keys.view(np.int64), np.arange(len(CLASSES))])
                kind = np.arange(len(keys)) < len(keys) - len(CLASSES)
                out.append((pa.array([name] * len(keys)), pa.array(kind), pa.array(keys), pa.array(np.concatenate([n, classes[k]]))))
            for columns in out:
                yield pa.RecordBatch.from_arrays(list(columns), names=["lang", "is_word", "key", "n"])

    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = rows.mapInArrow(run, "lang string, is_word boolean, key long, n long")
    return counts.groupBy("lang", "is_word", "key").agg(F.sum("n").alias("n"))


def fit_references(docs: DataFrame) -> References | None:
    """References of the languages; None if no labelled text passes the base rules."""
    counts = settle(reference_counts(docs))
    words = counts.filter("is_word")
    sums = words.groupBy("lang").agg(F.sum("n").alias("total"))
    totals = {r.lang: r.total for r in sums.orderBy(F.desc("total"), "lang").limit(LANGUAGES).collect()}
    if not totals:
        return None
    languages = sorted(totals)
    everything = sums.agg(F.sum("total")).first()[0]
    bound = F.create_map(*[F.lit(v) for lang, total in totals.items() for v in (lang, COMMON * total)])
    # at most 1 / COMMON words and the classes, for each language and for all together
    own = counts.filter(F.col("lang").isin(languages) & (~F.col("is_word") | (F.col("n") >= F.element_at(bound, F.col("lang"))))).collect()
    mixed = counts.groupBy("is_word", "key").agg(F.sum("n").alias("n"))
    mixed = mixed.filter(~F.col("is_word") | (F.col("n") >= COMMON * everything)).collect()
    keys = np.unique(np.array([r.key for r in [*own, *mixed] if r.is_word], np.int64).view(np.uint64))

    def histogram(rows: list, total: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters by class, and shares of the words, the last of which is all others."""
        classes, shares = np.zeros(len(CLASSES)), np.zeros(len(keys) + 1)
        for r in rows:
            if r.is_word:
                shares[np.searchsorted(keys, np.uint64(r.key % (1 << 64)))] = r.n / total
            else:
                classes[r.key] = r.n
        shares[-1] = 1 - shares.sum()
        return classes, shares

    all_classes, all_shares = histogram(mixed, everything)
    all_classes = all_classes / max(1, all_classes.sum())
    classes, shares = np.zeros((len(languages), len(CLASSES))), np.zeros((len(languages), len(keys) + 1))
    for k, lang in enumerate(languages):
        seen, share = histogram([r for r in own if r.lang == lang], totals[lang])
        seen = seen + PRIOR * PRIOR_CHARACTERS * all_classes
        classes[k] = seen / max(1, seen.sum())
        shares[k] = (totals[lang] * share + PRIOR * all_shares) / (totals[lang] + PRIOR)
    return References(languages, classes, keys, shares)


def distance(rows: np.ndarray, bins: np.ndarray, p: np.ndarray, q: np.ndarray, n_rows: int) -> np.ndarray:
    """Jensen-Shannon distance of sparse distributions (row, bin, share) from each reference."""
    out = np.zeros((n_rows, len(q)))
    for k, reference in enumerate(q):
        r = reference[bins]
        # bins that the text lacks add half of their share each
        with np.errstate(divide="ignore", invalid="ignore"):
            of_r = np.where(r > 0, r * np.log2(2 * r / (p + r)), 0.0) - r
        value = np.bincount(rows, p * np.log2(2 * p / (p + r)) + of_r, minlength=n_rows)
        out[:, k] = np.sqrt(np.clip((value + 1) / 2, 0, 1))
    return out


def distances(part: Slice, hashes: np.ndarray, refs: References) -> tuple[np.ndarray, np.ndarray]:
    """Distances of a slice's rows from all languages, by character classes and by words."""
    classes = class_counts(part)
    share = classes / np.maximum(1, classes.sum(axis=1, keepdims=True))
    rows, bins = np.nonzero(share)
    by_class = distance(rows, bins, share[rows, bins], refs.classes, part.rows)
    n = len(refs.words)
    at = np.searchsorted(refs.words, hashes)
    at[at == n] = 0
    at = np.where(refs.words[at] == hashes, at, n) if n else np.zeros(len(hashes), np.int64)
    keys, count = np.unique(part.row * (n + 1) + at, return_counts=True)
    rows, bins = keys // (n + 1), keys % (n + 1)
    total = np.maximum(1, np.diff(part.words))
    by_word = distance(rows, bins, count / total[rows], refs.shares, part.rows)
    return by_class, by_word


def limits(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Limits of characters and of words for texts of these lengths."""
    short = np.minimum(np.maximum(n_words, 1), FULL_LENGTH)
    wider = 1 / np.sqrt(short) - 1 / np.sqrt(FULL_LENGTH)
    return CHARACTER_LIMIT + CHARACTER_GUARD * wider, WORD_LIMIT + WORD_GUARD * wider


def judge(docs: DataFrame, refs: References | None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance and word_distance (from the nearest language; null where not judged).

    A null text is an empty one and fails the base rules.  Without references the base rules
    decide alone.  Repeated rows get equal answers; an empty table gives no rows; columns
    other than doc_id and text are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(refs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = sent.value
        for batch in batches:
            for part in slices(batch.column(1)):
                hashes = part.hashes()
                counts = base_counts(part, hashes)
                failed = base_failed(counts)
                kept = ~failed
                near = [np.full(part.rows, np.nan), np.full(part.rows, np.nan)]
                if refs is not None:
                    by_class, by_word = distances(part, hashes, refs)
                    most_class, most_word = limits(counts["n_words"])
                    like = (by_class <= most_class[:, None]) & (by_word <= most_word[:, None])
                    kept &= like.any(axis=1)
                    near = [by_class.min(axis=1), by_word.min(axis=1)]
                columns = [batch.column(0).slice(part.first, part.rows), *[pa.array(c.astype(np.int64)) for c in counts.values()]]
                columns += [pa.array(failed), pa.array(kept), *[pa.array(d, from_pandas=True) for d in near]]
                names = [ID, *counts, "base_failed", "kept", "class_distance", "word_distance"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    longs = ", ".join(f"{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    shape = f"{ID} {dict(docs.dtypes)[ID]}, {longs}, base_failed boolean, kept boolean, class_distance double, word_distance double"
    return docs.select(ID, "text").mapInArrow(run, shape)
