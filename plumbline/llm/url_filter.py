"""URL filters by Bloom filter cascades: exact membership in rule lists, without joins.

A rule is a host and a path prefix, written together (``example.net/en/``).  A url's
candidate keys are its host and every parent domain with every prefix of its path whose
length some rule has.  The distinct candidate keys of the whole corpus are the universe of
the cascade: level 1 holds the listed keys, level 2 the unlisted keys that level 1 accepts,
level 3 the listed keys that level 2 accepts, and so on until a level accepts nothing wrong.
Each level is counted over all keys by Spark and merged by ``bit_or`` of its words; the first
level is sized so that about as many false keys pass as keys are listed, so the cascade grows
with the list and the logarithm of the universe, and fits a broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.exact_dedup import LOWER, UPPER
from plumbline.llm.shared import fresh, mix, settle

#: fixed values: the rules of the contract
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: bytes that the filters of one list may take in a broadcast
MAX_BYTES = 64 << 20
HASHES = 8
#: keys that one task of a level reads
KEYS_PER_TASK = 1_000_000
#: listed keys that are broadcast (8 bytes each) to take them out of the universe; more are joined by a shuffle
BROADCAST_KEYS = 1_000_000
_KEY = "host_part string, path_part string"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A to Z lower-cased) and path; both empty for a null or a url without ``://``."""
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, r"(?s)://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(text, r"(?s)://[^/?#]*([^?#]*)", 1)


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def key_hash(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"))


class Level:
    """A Bloom filter; ``salt`` gives each level hash functions of its own."""

    def __init__(self, expected: int, rate: float, salt: int):
        self.salt = np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
        self.probes = min(HASHES, max(1, round(-math.log2(rate))))
        # bits per key for which so many probes reach the rate
        per_key = -self.probes / math.log(1 - rate ** (1 / self.probes))
        self.n_words = max(1, math.ceil(expected * per_key / 64))
        self.words = np.zeros(self.n_words, np.uint64)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        h = mix(hashes ^ self.salt)
        step = mix(h) | np.uint64(1)
        probes = np.arange(self.probes, dtype=np.uint64)
        return (h[:, None] + probes * step[:, None]) % np.uint64(64 * self.n_words)

    def bits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word indexes and the bits to set there."""
        at = self.places(hashes).ravel()
        words, where = np.unique((at >> np.uint64(6)).astype(np.int64), return_inverse=True)
        out = np.zeros(len(words), np.uint64)
        np.bitwise_or.at(out, where, np.uint64(1) << (at & np.uint64(63)))
        return words, out

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = self.places(hashes)
        return ((self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


class Cascade:
    """Levels in order; exact for every key of the universe it was built over."""

    def __init__(self):
        self.levels: list[Level] = []

    def passed(self, hashes: np.ndarray) -> np.ndarray:
        """How many levels accept each key before one refuses it."""
        depth = np.zeros(len(hashes), np.int64)
        alive = np.arange(len(hashes))
        for level in self.levels:
            alive = alive[level.holds(hashes[alive])]
            depth[alive] += 1
        return depth

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """An odd depth means listed: the key is in an odd level and not in the even one after it."""
        return self.passed(hashes) % 2 == 1

    @property
    def n_bytes(self) -> int:
        return sum(8 * level.n_words for level in self.levels)


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade:
    """Cascade that tells the hashes of ``listed`` from all others of ``universe`` (columns ``h``, distinct)."""
    n_listed = listed.count()
    n_others = universe.count()
    cascade = Cascade()
    if n_listed == 0:
        cascade.levels.append(Level(1, 0.5, 1))
        return cascade
    members = listed
    others = universe.join(F.broadcast(listed) if n_listed <= BROADCAST_KEYS else listed, "h", "left_anti")
    rate = min(0.5, n_listed / (math.sqrt(2) * max(1, n_others)))
    for depth in range(1, 200):
        side = members if depth % 2 else others
        # keys of this side that the levels so far still accept
        left = side.mapInPandas(_still_in(cascade, depth - 1), "h long")
        count = n_listed if depth == 1 else left.count()
        if count == 0:
            break
        level = Level(count, rate if depth == 1 else 0.5, depth)
        if cascade.n_bytes + 8 * level.n_words > max_bytes:
            raise ValueError(f"the cascade needs more than {max_bytes} bytes; split the list")
        merged = left.mapInPandas(_bits_of(level), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        table = merged.toArrow()  # one row per word of the filter, whose size is checked above
        level.words[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
        cascade.levels.append(level)
    return cascade


def _hashes(pdf: pd.DataFrame) -> np.ndarray:
    return pdf["h"].to_numpy(np.int64).view(np.uint64)


def _still_in(cascade: Cascade, depth: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[cascade.passed(_hashes(pdf)) == depth] if depth else pdf

    return run


def _bits_of(level: Level):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            words, bits = level.bits(_hashes(pdf))
            yield pd.DataFrame({"word": words, "bits": bits.view(np.int64)})

    return run


def candidate_keys(host: str, path: str, lengths: list[int]) -> list[str]:
    """Keys of a url that a rule could have, longest first."""
    hosts = [host]
    while "." in hosts[-1]:
        hosts.append(hosts[-1].partition(".")[2])
    keys = [h + path[:n] for h in hosts for n in lengths if len(path) >= n]
    return sorted(keys, key=len, reverse=True)


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules`` has (rule, verdict); of repeated rules a blocking one holds.  The longest rule
    that fits decides; where none does, the url is in no list and gets ``default``.  Null
    urls and urls without ``://`` have an empty host and path, which no rule fits.  Repeated
    urls get equal answers; an empty table gives no rows.  Columns of ``pages`` named like
    the four results are replaced.
    """
    spark = pages.sparkSession
    host, path = split_url(F.col("url"))
    pages = pages.drop("host", "path", "rule", "verdict")
    at = fresh(pages, "key")
    asked = pages.withColumn(at, F.struct(host.alias("host"), path.alias("path")))
    lengths = [r.n for r in rules.select(F.length(F.regexp_extract("rule", r"(/.*)?$", 0)).alias("n")).distinct().collect()]
    distinct = asked.select(F.col(f"{at}.host").alias("host"), F.col(f"{at}.path").alias("path"))
    universe = _few_tasks(settle(distinct.mapInPandas(_keys(lengths), "h long").distinct()))
    ruled = rules.groupBy("rule").agg(F.max(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("blocks"))
    hashed = _few_tasks(settle(ruled.mapInPandas(_rule_hash, "h long, blocks long")))
    cascades = {
        verdict: spark.sparkContext.broadcast(build_cascade(hashed.filter(f"blocks = {b}").select("h").distinct(), universe))
        for verdict, b in (("block", 1), ("allow", 0))
    }
    judged = asked.mapInPandas(_judge(cascades, lengths, at, default), _schema(asked, at))
    return judged


def _few_tasks(keys: DataFrame) -> DataFrame:
    """A settled table of keys, in no more parts than its size needs; each level reads it again."""
    return keys.coalesce(max(1, keys.count() // KEYS_PER_TASK))


def _schema(asked: DataFrame, at: str) -> str:
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema if f.name != at]
    return ", ".join([*kept, "host string", "path string", "rule string", "verdict string"])


def _keys(lengths: list[int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = {k for h, p in zip(pdf["host"], pdf["path"], strict=True) for k in candidate_keys(h, p, lengths)}
            yield pd.DataFrame({"h": np.array([key_hash(k) for k in found], np.uint64).view(np.int64)})

    return run


def _rule_hash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        h = np.array([key_hash(k) for k in pdf["rule"]], np.uint64).view(np.int64)
        yield pd.DataFrame({"h": h, "blocks": pdf["blocks"].astype("int64")})


def _judge(cascades: dict, lengths: list[int], at: str, default: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hosts, paths = [k["host"] for k in pdf[at]], [k["path"] for k in pdf[at]]
            keys = [candidate_keys(h, p, lengths) for h, p in zip(hosts, paths, strict=True)]
            flat = [k for of in keys for k in of]
            hashes = np.array([key_hash(k) for k in flat], np.uint64)
            says = np.full(len(flat), "", object)
            for verdict, cascade in cascades.items():
                says[cascade.value.holds(hashes)] = verdict
            rules, verdicts, i = [], [], 0
            for of in keys:
                hit = next((j for j in range(i, i + len(of)) if says[j]), None)
                rules.append(None if hit is None else flat[hit])
                verdicts.append(default if hit is None else says[hit])
                i += len(of)
            yield pdf.drop(columns=at).assign(host=hosts, path=paths, rule=rules, verdict=verdicts)

    return run
