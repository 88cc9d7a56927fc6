"""Spelling variants by permuterm rotations.

A word is closed by a terminator and rotated.  Rotated so that its edited character comes last,
``a x b`` reads ``b $ a x``: all words that replace that character share the range of the prefix
``b $ a``, and the word without it, ``a b``, has that prefix as a rotation of its own.  So each
rotation enters the sort twice, as itself and without its last character; the entries are
range-partitioned and sorted, and a scan meets each group of words that are one edit apart in
one run.  A prefix holds the terminator in a fixed place, so a run has at most one word for each
character and one that lacks it: no group grows with the corpus, and no pairs are written.  For
each of its words a run gives the number of near words it adds and the best of them.

Replacements of two words meet in one run only.  An indel inside a row of equal characters meets
in several; only the first of them counts.

Words have numbers in code-point order, so entries are narrow and ties compare as the words do.
Rotations longer than ``SPELLED`` characters are written as fingerprints (values of a polynomial
modulo 2^61 - 1 at two points drawn for the run), so that a word of a million letters costs as many
short rows, not as many copies of itself.
"""

from __future__ import annotations

import re
import secrets as random_source
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import ID, settle

#: fixed values of the contract
RUN = re.compile("[A-Za-zÀ-ÿ]+")
MUTATED, MIN_LENGTH, MIN_COUNT, RATIO = 97, 5, 3, 2
TERMINATOR = "$"
#: characters up to which a rotation is written out
SPELLED = 64
#: characters of a text that are searched at once, and rows of an output batch
CHUNK, BATCH_ROWS = 1 << 20, 50_000
_PRIME = (1 << 61) - 1
#: kinds of entries: a rotation itself; without its last character; the same, and an indel there counts
WHOLE, SHORT, INDEL = 0, 1, 2


# ---------------------------------------------------------------------- words


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Parts of a text, cut where no run of letters is."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        inside = RUN.match(text, end)
        end = inside.end() if inside else end
        yield text[at:end]
        at = end


def mutated(run: str, prefix_crc: int) -> str:
    """The run, or the run without one character, as the hash of document and run says."""
    h = zlib.crc32(run.encode(), prefix_crc)
    if h % MUTATED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of all words that are long and frequent enough; counted in batches first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                prefix = zlib.crc32(f"{name}:".encode())
                lowered = text.cast(pa.binary()).as_py().lower().decode("utf-8", "replace")  # A to Z only
                runs: Counter = Counter()
                for part in chunks(lowered):
                    runs.update(RUN.findall(part))
                for word, n in runs.items():
                    word = mutated(word, prefix)
                    if len(word) >= min_length:
                        total[word] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    named = docs.select(F.coalesce(F.col(ID).cast("string"), F.lit("")).alias("name"), "text")
    return named.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def numbered(words: DataFrame) -> DataFrame:
    """word, n and a number that grows with the word in code-point order."""
    ordered = words.repartitionByRange("word").sortWithinPartitions("word")
    return settle(ordered.withColumn("number", F.monotonically_increasing_id()))


# ------------------------------------------------------------------ rotations


class Fingerprints:
    """Fingerprints of the pieces ``b $ a`` of one word, from running sums."""

    def __init__(self, word: str, bases: tuple[int, int]):
        codes = [ord(c) for c in word]
        self.length = len(codes)
        self.tables = []
        for base in bases:
            sums, powers = [0], [1]
            for c in codes:
                sums.append((sums[-1] * base + c) % _PRIME)
                powers.append(powers[-1] * base % _PRIME)
            powers.append(powers[-1] * base % _PRIME)
            self.tables.append((sums, powers, base))

    def rotation(self, start: int, stop: int) -> str:
        """Name of ``word[start:] $ word[:stop]``, with its length."""
        tail = self.length - start
        values = []
        for sums, powers, base in self.tables:
            of_tail = (sums[-1] - sums[start] * powers[tail]) % _PRIME
            value = (of_tail * base + ord(TERMINATOR)) % _PRIME
            values.append((value * powers[stop] + sums[stop]) % _PRIME)
        return f"{TERMINATOR}{tail + 1 + stop}:{values[0]:x}:{values[1]:x}"


def entries(word: str, bases: tuple[int, int]) -> Iterator[tuple[str, int]]:
    """(key, kind) of a word's rotations, whole and without their last character."""
    n = len(word)
    if n + 1 > SPELLED:
        prints = Fingerprints(word, bases)
        whole = prints.rotation
    else:
        whole = lambda start, stop: f"{word[start:]}{TERMINATOR}{word[:stop]}"
    short = whole if n > SPELLED else lambda start, stop: f"{word[start:]}{TERMINATOR}{word[:stop]}"
    for i in range(n + 1):
        yield whole(i, i), WHOLE
    for i in range(n):
        # the rotation that ends with character i, without it
        yield short(i + 1, i), SHORT if i and word[i] == word[i - 1] else INDEL


def rotation_rows(words: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """key, kind, n, number: the entries of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, kinds, counts, numbers = [], [], [], []

        def packed() -> pa.RecordBatch:
            columns = [pa.array(keys, pa.string()), pa.array(kinds, pa.int32()), pa.array(counts, pa.int64()), pa.array(numbers, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["key", "kind", "n", "number"])

        for batch in batches:
            for word, n, number in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for key, kind in entries(word, bases):
                    keys.append(key)
                    kinds.append(kind)
                    counts.append(n)
                    numbers.append(number)
                    if len(keys) >= BATCH_ROWS:
                        yield packed()
                        keys, kinds, counts, numbers = [], [], [], []
        if keys:
            yield packed()

    return words.select("word", "n", "number").mapInArrow(run, "key string, kind int, n long, number long")


# ----------------------------------------------------------------------- scan


def scan_groups(key: pa.Array, kind: np.ndarray, n: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, ...]:
    """(number, near, best_n, best) of the words of whole groups; rows are sorted by key, n falling, number."""
    rows = len(key)
    same = pc.equal(key.slice(1), key.slice(0, rows - 1)).to_numpy(zero_copy_only=False) if rows > 1 else np.zeros(0, bool)
    heads = np.flatnonzero(np.append(True, ~same))
    size = np.diff(np.append(heads, rows))
    replaced = np.add.reduceat((kind != WHOLE).astype(np.int64), heads)
    indels = np.add.reduceat((kind == INDEL).astype(np.int64), heads)
    group = np.repeat(np.arange(len(heads)), size)
    near = np.where(kind == WHOLE, indels[group], replaced[group] - 1 + ((kind == INDEL) & (replaced < size)[group]))
    at = np.arange(rows)
    # the best of the others: the first row, or the second one for the first
    best = np.where(at == heads[group], heads[group] + 1, heads[group])
    met = size[group] > 1
    best = best[met]
    return number[met], near[met], n[best], number[best]


def near_words(words: DataFrame, bases: tuple[int, int] | None = None) -> DataFrame:
    """number, n_near, best_n, best of every word that has a near one; ``words`` as ``numbered`` gives them."""
    bases = bases or tuple(1000 + random_source.randbelow(_PRIME - 2000) for _ in range(2))
    names = ["number", "near", "best_n", "best"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def scanned(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            key = table["key"].chunk(0)
            found = scan_groups(key, *(table[c].to_numpy() for c in ("kind", "n", "number")))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            # the last group may go on; a group has at most a row for each character
            keys = held["key"].combine_chunks()
            keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
            last = held.num_rows - 1
            while last > 0 and keys[last - 1].as_py() == keys[held.num_rows - 1].as_py():
                last -= 1
            if last:
                yield scanned(held.slice(0, last))
                held = held.slice(last).combine_chunks()
        if held is not None and held.num_rows:
            yield scanned(held)

    order = [F.col("key"), F.col("n").desc(), F.col("number")]
    rotations = rotation_rows(words, bases)
    found = rotations.repartitionByRange("key").sortWithinPartitions(*order).mapInArrow(run, ", ".join(f"{c} long" for c in names))
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    summed = found.groupBy("number").agg(F.sum("near").alias("n_near"), first.alias("first"))
    return summed.select("number", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))


# ---------------------------------------------------------------------- roots


def roots(forms: DataFrame, most: int, least: int, ratio: int = RATIO) -> DataFrame:
    """number, root from number, form: each step follows twice as many forms.

    Counts grow by ``ratio`` from a word to its form, so a chain has no more than log(most / least)
    forms, and the steps are the logarithm of that.
    """
    longest = max(1, int(np.log(max(1, most / max(1, least))) / np.log(ratio)) + 1)
    state = settle(forms.select("number", F.col("form").alias("root")))
    for _ in range(max(0, int(longest - 1).bit_length())):
        onward = state.select(F.col("number").alias("root"), F.col("root").alias("further"))
        state = settle(state.join(onward, "root", "left").select("number", F.coalesce("further", "root").alias("root")))
    return state


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the whole texts.

    Two words are near if one inserted, deleted or replaced code point makes one the other.  A
    word's form is its near word of largest n (ties: the smallest) if that is ``ratio`` times its own
    at least; root is where forms lead.  A null text has no words, a missing id hashes as an empty
    one.  Repeated rows count each time.  No words give no rows; other columns are not read.
    """
    if min_count < 1 or ratio < 2:
        raise ValueError("forms must grow: min_count is 1 and ratio is 2 at least")
    words = numbered(word_counts(docs, min_length, min_count))
    found = words.select("number", "word", "n").join(near_words(words), "number", "left")
    has_form = F.col("best_n") >= ratio * F.col("n")
    known = settle(found.select("number", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n")))
    most = known.agg(F.max("n")).first()[0]
    with_form = known.filter("form IS NOT NULL")
    rooted = roots(with_form, most or 1, min_count, ratio)
    spelled = lambda c: words.select(F.col("number").alias(c), F.col("word").alias(f"{c}_word"))
    named = with_form.select("number", "form").join(rooted, "number").join(spelled("form"), "form").join(spelled("root"), "root")
    result = known.drop("form").join(named.select("number", "form_word", "root_word"), "number", "left")
    return result.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
