"""URL filters, sharding, packing, sampled pieces and the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from plumbline.llm import packing, sampled_pieces
from plumbline.llm.sharding import shard_rows
from plumbline.llm.shared import text_buffers
from plumbline.llm.url_filter import RULES, build_cascade, filter_urls

# ------------------------------------------------------------------ url filter


def brute_verdict(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in rules if (h := r.partition("/")[0]) and (host == h or host.endswith("." + h)) and path.startswith(r[len(h) :])]
    rule = max(fits, key=len, default=None)
    return host, path, rule, rules[rule] if rule else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://NET/x", "x://a.b.net/?q", "http://fornet/", "http://example.net/en", "http://example.net/en/",
    "http://m.Example.net/en/1#top", "http://example.net/EN/", "http://example.com/de/9?x=://net/", "http://example.com", "https://u.org/fr/", "http://u.org/fr", "a://b://net/",
    "http://net./", "http://x.net?y/", "http://.net/", "http://é.org/fr/ü",
]


def test_url_verdicts_equal_brute_force(spark):
    rng = random.Random(1)
    urls = URLS * 2 + [f"http://{rng.choice(['a.', '', 'b.c.'])}{rng.choice(['net', 'example.net', 'org', 'example.com', 'other'])}/{rng.choice(['en', 'de', 'fr', ''])}{rng.choice(['/', ''])}" for _ in range(200)]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string").withColumn("h", F.lit(1))
    rules = spark.createDataFrame(list(RULES.items()), "rule string, verdict string")
    got = {r.page_id: r for r in filter_urls(pages, rules).collect()}
    for i, u in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == brute_verdict(u, RULES), u
        assert got[i].url == u
    assert filter_urls(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in filter_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(-(1 << 63), 1 << 63, 20_000))
    rng.shuffle(keys)
    universe = spark.createDataFrame([(int(k),) for k in keys], "h long")
    listed = spark.createDataFrame([(int(k),) for k in keys[:1500]], "h long")
    cascade = build_cascade(listed, universe)
    says = cascade.holds(keys.view(np.uint64))
    assert len(cascade.levels) > 2 and says[:1500].all() and not says[1500:].any()
    assert cascade.n_bytes < 8 * 1500


# -------------------------------------------------------------------- sharding


@pytest.mark.parametrize("interval", [1 << 30, 3000])
def test_shards_are_near_equal_and_slots_gapless(documents, interval):
    rng = random.Random(6)
    rows = [(i, "x" * rng.randrange(200)) for i in range(900)] + [(1000 + i, "hot text " * 9) for i in range(500)] + [(2000, None), (2001, ""), (None, "n"), (7, "again")]
    got = shard_rows(documents(rows).withColumn("part", F.lit(1)), 8, interval).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((i is None, i or 0, len(t or "") + 1) for i, t in rows)
    size, slots, crc = Counter(), defaultdict(list), Counter(zlib.crc32((t or "").encode()) for _, t in rows)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter(r.text_crc32 for r in got) == crc
    total = sum(size.values())
    assert set(size) == set(range(8)) and all(abs(s - total / 8) <= 2 * 200 + 0.02 * total / 8 for s in size.values())
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_shards_of_one_text_and_of_nothing(documents):
    got = shard_rows(documents([(i, "same") for i in range(800)]), 8).collect()
    assert max(Counter(r.shard for r in got).values()) <= 101
    assert shard_rows(documents([]), 8).collect() == []
    assert [(r.shard >= 0, r.slot) for r in shard_rows(documents([(1, "one")]), 8).collect()] == [(True, 0)]
    assert len(shard_rows(documents([(1, "same")] * 20), 8).collect()) == 20


# --------------------------------------------------------------------- packing


def test_plan_places_every_piece_and_is_near_optimal():
    rng = np.random.default_rng(7)
    for capacity in (10, 64, 1024):
        counts = np.zeros(capacity + 1, np.int64)
        for n in rng.integers(1, capacity + 1, 400):
            counts[n] += rng.integers(1, 4)
        patterns = packing.plan(counts, capacity)
        placed = Counter()
        for pattern, times in patterns:
            assert sum(pattern) <= capacity and times > 0
            for n in pattern:
                placed[n] += times
        assert placed == Counter({n: int(c) for n, c in enumerate(counts) if c})
        bound = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
        big = int(counts[capacity // 2 + 1 :].sum())
        assert sum(t for _, t in patterns) <= 1.03 * max(bound, big) + 1


def optimum(lengths, capacity):
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in sorted({b: j for j, b in enumerate(bins)}.values()):
            if bins[k] >= lengths[i]:
                place(i + 1, bins[:k] + [bins[k] - lengths[i]] + bins[k + 1 :])
        place(i + 1, [*bins, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_reduction_never_costs_a_sequence():
    """What the reduction fixes leaves an optimum: fixed sets plus the best packing of the rest."""
    rng = random.Random(8)
    for _ in range(60):
        capacity = rng.choice([7, 10, 15])
        lengths = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))), reverse=True)
        counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
        fixed = packing.reduce_by_dominance(counts, capacity)
        rest = sorted((n for n, c in enumerate(counts) for _ in range(c)), reverse=True)
        assert sum(t for _, t in fixed) + optimum(rest, capacity) == optimum(lengths, capacity)


TEXTS = [None, "", "hello world", "<|endoftext|> it's  \n\n x", "日本語 текст " * 30, "a" * 3000, "naïve café\u00a0\x1c\x85 end ", "١٢٣ ½ ﬁ", "tab\tand  spaces   \n "]


def test_token_ids_equal_the_tokenizer():
    rng = random.Random(9)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice("ab'st \n1.,é–") for _ in range(60)) for _ in range(200)]
    for text in texts:
        assert packing.token_ids(text) == packing.tokenizer(None).encode(text, add_special_tokens=False).ids


def test_token_ids_of_texts_with_added_tokens():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.token_ids("a <|endoftext|> b") == [64, 220, 50256, 275]
    for text in [t or "" for t in TEXTS] + ["<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|EndOfText|>", "日本<|endoftext|>語"]:
        assert packing.token_ids(text) == plain.encode(text, add_special_tokens=False).ids


def test_packing_round_trip(documents):
    rng = random.Random(10)
    rows = list(enumerate(TEXTS)) + [(100 + i, " ".join(rng.choice(["the", "of", "zyx", "qqq"]) for _ in range(rng.choice([1, 7, 300, 1023, 2500, rng.randrange(900)])))) for i in range(60)]
    rows += [(None, "no id"), (100, "again")]
    got = packing.pack(documents(rows).withColumn("length", F.lit(1)).withColumn("part", F.lit(2)).repartition(3)).collect()
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    want = Counter()
    for i, text in rows:
        ids = np.array([*packing.token_ids(text or ""), packing.END], "<u4")
        for k, (a, n) in enumerate(packing.cut(len(ids), packing.CAPACITY)):
            want[i, k, a, n, zlib.crc32(ids[a : a + n].tobytes())] += 1
            assert n == packing.CAPACITY or k == 0
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bound = max(sum(r.length for r in got) / packing.CAPACITY, sum(r.length > packing.CAPACITY // 2 for r in got))
    assert len(bins) <= 1.05 * bound + 1
    assert packing.pack(documents([])).collect() == []


@pytest.mark.parametrize("run", [" ", "\n", " \n", "x", "#", "7"])
def test_token_ids_of_long_runs(run):
    text = "a" + run * (1_000_000 // len(run)) + "b"
    assert packing.token_ids(text) == packing.tokenizer(None).encode(text, add_special_tokens=False).ids


# --------------------------------------------------------------- sampled pieces

ODD = [None, "", " ", "a", "hello world", " lead  trail  ", "▁ x▁y", "\0\n\t\r", "日本語 é 𝔘𐍈", "a" * 5000, "é" * 700 + "\u2028", "��", "x  y\n\n  z"]


def encode(texts, seed=0, size=None):
    pieces = sampled_pieces.vocabulary()
    data, offsets = text_buffers(pa.array(texts, pa.string()))
    seeds = np.array([sampled_pieces.row_seed(i, seed) for i in range(len(texts))], np.uint64)
    ids, at = sampled_pieces.encode_slice(data, offsets, seeds, pieces)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_sampled_pieces_are_lossless_and_reproducible(documents):
    rows = list(enumerate(ODD)) + [(None, "key missing"), (3, "a")]
    docs = documents(rows).withColumn("ids", F.lit(1))
    one = {(r.doc_id, i): r for i, r in enumerate(sampled_pieces.sample_encode(docs.coalesce(1), seed=3).collect())}
    assert all(r.lossless for r in one.values())
    many = sampled_pieces.sample_encode(docs.repartition(5), seed=3)
    by_id = {r.doc_id: r.ids for r in many.collect()}
    assert all(r.ids == by_id[r.doc_id] for r in one.values())
    texts = {r.doc_id: r.text for r in sampled_pieces.decode_ids(many).collect()}
    assert texts == {i: t or "" for i, t in rows}
    assert sampled_pieces.sample_encode(documents([]), seed=3).collect() == []


def test_sampled_pieces_follow_the_lattice_distribution():
    """Frequencies of all segmentations of a short text against their exact probabilities."""
    pieces = sampled_pieces.vocabulary()
    table = {raw: i for i, raw in enumerate(pieces.raw) if raw and i >= 259}
    text = b" there"

    def paths(at):
        if at == len(text):
            yield ()
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in table:
                for rest in paths(end):
                    yield (table[text[at:end]], *rest)

    weight = {p: np.exp(pieces.weight[list(p)].sum()) for p in paths(0)}
    total = sum(weight.values())
    seen = Counter(tuple(ids) for seed in range(8) for ids in encode(["there"] * 1000, seed))
    for path, w in weight.items():
        p = w / total
        assert abs(seen[path] / 8000 - p) < 5 * np.sqrt(p * (1 - p) / 8000) + 1e-3


def test_sampled_ids_do_not_depend_on_neighbours():
    texts = [f"word{i} and other things {i * 7919} é" for i in range(300)]
    together = encode(texts)
    for i in (0, 17, 299):
        alone = encode([None] * i + [texts[i]])
        assert alone[i] == together[i]


# --------------------------------------------------------------------- pipeline


def test_pipeline_stages_keep_clean_documents(spark, tmp_path):
    rng = random.Random(11)
    pools = {"en": ["the", "this", "with", "which", "house"], "de": ["und", "nicht", "der", "schön", "über"]}
    text = lambda lang, n: " ".join(rng.choice(pools[lang]) + rng.choice(["", "en", "er", "st"]) for _ in range(n))
    rows = [(i, text(lang := "en" if i % 2 else "de", 40 + i), lang, "s", 1) for i in range(80)]
    rows += [(200, rows[3][1], "de", "s", 1), (201, rows[60][1] + " more", "de", "s", 1), (202, "12345 678", None, "s", 1), (203, None, None, "s", 1)]
    rows.append((204, text("en", 60) + ' token = "' + "0f3b" * 10 + '" ' + text("en", 9), "en", "s", 1))
    schema = T.StructType([T.StructField(n, t) for n, t in [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]])
    docs = spark.createDataFrame(rows, schema)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    ids, frame = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        frame = spark.read.parquet(f"{folder}/{name}")
        ids[name] = {r.doc_id for r in frame.select("doc_id").collect()}
    everyone = {r[0] for r in rows}
    assert ids["language_id"] == everyone - {202, 203}
    assert ids["exact_dedup"] == ids["language_id"] - {3}
    assert ids["ngram_jaccard_join"] == ids["exact_dedup"] - {201}
    assert ids["secret_scan"] == ids["best_fit_packing"] == ids["ngram_jaccard_join"]
    kept = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/secret_scan").collect()}
    assert "0f3b" not in kept[204] and "[secret]" in kept[204]
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == ids["best_fit_packing"]


def test_pipeline_keeps_documents_where_nothing_is_labelled(documents, spark):
    docs = documents([(i, f"text number {i} of some words") for i in range(20)])
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == 20
