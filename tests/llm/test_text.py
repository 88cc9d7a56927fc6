"""Secret scans, divergence rules and language ID against plain versions and held-out truth."""

import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import divergence, language_id, secrets
from plumbline.llm.shared import slices

# -------------------------------------------------------------------- secrets

RULES = [
    ("assign", re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def brute_spans(text):
    spans = []
    for kind, pattern, group, least in RULES:
        spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return sorted(spans, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def token(rng, n, of="0123456789abcdef"):
    return "".join(rng.choice(of) for _ in range(n))


def secret_rows():
    rng = random.Random(4)
    rows = [
        (1, None), (2, ""), (3, "secret=token:abc123456 PASSWORD : 'longenough' api_key=x apikey==abcdefg"), (4, "é" * 30 + "AKIA" + "A" * 16 + "AKIA12"),
        (5, "AKIAKIA" + "9" * 12 + " AKIA123"), (6, token(rng, 24) + "G" + token(rng, 23)), (7, "token = \"" + token(rng, 40) + "\" x" + "a" * 100_000), (8, "ſecret=abcdef toKen=abcdef"),
    ]
    for i in range(300):
        body = " ".join(token(rng, rng.randrange(3, 20), "etaoinshr") for _ in range(40))
        if i % 3 == 0:
            body += f' token = "{token(rng, 40)}" ' + body
        if i % 5 == 0:
            body += " card " + "4" + token(rng, 15, "0123456789") + " " + body[:50]
        rows.append((100 + i, body))
    return rows


def test_secret_rules_equal_the_contract(documents):
    rows = secret_rows()
    docs = documents(rows).withColumn("spans", F.lit("x")).withColumn("label", F.lit(1))
    scanner = secrets.fit(docs)
    got = {r.doc_id: r for r in secrets.scan(docs, scanner).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        base = brute_spans(text)
        kinds = [s[0] for s in base]
        r = got[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [kinds.count(k) for k in ("assign", "access", "hex")]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == sha256(joined.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("learned")] == ([f"{k}:{a}:{b}" for k, a, b in base])


def test_secret_network_finds_what_no_rule_names(documents):
    scanner = secrets.fit(documents(secret_rows()))
    rng = random.Random(9)
    plain = [(i, " ".join(token(rng, 18, "etaoinshr") for _ in range(12))) for i in range(50)]
    assert not any(r.n_learned for r in secrets.scan(documents(plain), scanner).collect())
    # a letter breaks each token into runs that are too short for the rule
    near = [(i, f'etaoin tokens = "{token(rng, 20)}g{token(rng, 19)}" etaoin') for i in range(50)]
    assert sum(r.n_learned for r in secrets.scan(documents(near), scanner).collect()) >= 25


def test_secret_threshold_keeps_the_recall():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 800)
    x = rng.integers(97, 123, (800, secrets.LENGTH)).astype(np.uint8)
    x[y == 1, 20:40] = rng.integers(48, 58, (int(y.sum()), 20))
    scanner = secrets.train(x, y)
    assert (scanner.score(x[y == 1]) >= scanner.threshold).mean() >= secrets.RECALL - 0.01
    assert (scanner.score(x[y == 0]) >= scanner.threshold).mean() <= 0.01


def test_secret_threshold_keeps_the_recall_of_overlapping_classes():
    rng = np.random.default_rng(2)
    y = (rng.random(3000) < 0.3).astype(int)
    x = rng.integers(97, 123, (3000, secrets.LENGTH)).astype(np.uint8)
    # of the secrets one in five looks like any other text
    rows = np.flatnonzero((y == 1) & (rng.random(3000) < 0.8))
    x[rows, 20:40] = rng.integers(48, 58, (len(rows), 20))
    scanner = secrets.train(x, y)
    assert scanner.threshold < 0.5 and scanner.recall >= secrets.RECALL
    assert (scanner.score(x[y == 1]) >= scanner.threshold).mean() >= secrets.RECALL - 0.03
    # what it costs is stated
    assert abs(scanner.precision - y[scanner.score(x) >= scanner.threshold].mean()) < 0.1


def short_and_long_rows():
    rng, of = random.Random(6), "ABCDEFGHJKLMNPQRSTUVWXYZ23456789"
    rows = []
    for i in range(600):
        words = " ".join(token(rng, rng.randrange(3, 12), "etaoinshr") for _ in range(30))
        rows.append((i, f'{words} password: {token(rng, rng.choice([8, 9, 12, 24]), of)} {words} /{token(rng, 9, "etaoinshr")}/{token(rng, 30, "etaoinshr")}/x {words}'))
    return rows


def test_secret_behind_a_long_head_and_short_secrets(documents):
    scanner = secrets.fit(documents(short_and_long_rows()))
    rng, of = random.Random(7), "ABCDEFGHJKLMNPQRSTUVWXYZ23456789"
    head = "/".join(token(rng, 9, "etaoinshr") for _ in range(20))
    long_ = [(i, f"see {head}/{token(rng, 24, of)}/{head} there") for i in range(50)]
    short = [(100 + i, f"hit pwd: {token(rng, 8, of)} there") for i in range(50)]
    plain = [(200 + i, f"see {head[i:]} there isthe toaster") for i in range(50)]
    got = {r.doc_id: r for r in secrets.scan(documents(long_ + short + plain), scanner).collect()}
    assert sum(f"learned:4:{len(t) - 6}" == got[i].spans for i, t in long_) >= 45
    assert sum("learned:9:17" == got[i].spans for i, _ in short) >= 45
    assert sum(got[i].n_learned for i, _ in plain) <= 5


def test_secret_windows_read_every_candidate_whole():
    rng = random.Random(8)
    texts = ["", "x" * 5, "y" * 6, "é a_long/run=" + token(rng, 500) + " b", "token=a.b.c.d " + "z" * 57, "q" * 90_000 + " end\x00 ending"]
    spans, values = zip(*map(secrets.marked_spans, texts), strict=True)
    of = secrets.windows(texts, spans, values)
    assert [texts[i][a:b] for i, a, b in zip(of.text, of.start, of.end)] == ["y" * 6, "a_long/run=", texts[3][13:513], "a.b.c.d", "z" * 57, "q" * 90_000, "ending"]
    codes = of.codes(np.arange(len(of.owner)))
    for k in range(len(of.start)):
        rows = np.flatnonzero(of.owner == k)
        read = np.unique(np.concatenate([np.arange(a, b) for a, b in zip(of.left[rows], of.right[rows])]))
        assert len(read) == of.end[k] - of.start[k]
        text, a = texts[of.text[k]], of.start[k]
        assert bytes(codes[rows[0]]).replace(b"\0", b"") == (text[max(0, a - 16) : a] + text[a : min(a + 40, of.end[k])] + text[min(a + 40, of.end[k]) :][:16]).encode("latin-1").replace(b"\0", b"")
    y = np.arange(200) % 2
    x = np.random.default_rng(3).integers(48, 123, (200, secrets.LENGTH)).astype(np.uint8)
    scanner = secrets.train(x, y)
    assert np.allclose(scanner.score_windows(of), scanner.score(codes), atol=1e-5)


def test_secret_sample_keeps_both_labels_of_skewed_copies(documents, monkeypatch):
    monkeypatch.setattr(secrets, "SAMPLE", 8)
    rng = random.Random(3)
    # 2,000 copies of one secret, and 20 different plain runs, one of them in every document
    plain = [token(rng, 20, "etaoinshr") for _ in range(20)]
    docs = documents([(i, f'{plain[i % 20]} padding of a context token = "{"0f" * 20}" and more context {plain[0]}') for i in range(2000)]).repartition(3)
    rows = secrets.findings(docs).collect()
    by = {k: [r for r in rows if r.label == k] for k in (0, 1)}
    assert len(by[0]) == 8 and 1 <= len(by[1]) <= 8
    assert sum(r.n for r in by[1]) == 2000
    assert len({bytes(r.codes) for r in by[0]}) == 8 and min(r.n for r in by[0]) >= 50
    assert secrets.fit(docs) is not None


def labelled_windows(texts):
    spans, values = zip(*map(secrets.marked_spans, texts), strict=True)
    of = secrets.windows(texts, spans, values)
    return of.codes(np.arange(len(of.owner))), of.secret[of.owner]


def test_secret_steps_and_threshold_take_every_window(documents, monkeypatch):
    monkeypatch.setattr(secrets, "SAMPLE", 8)
    rows = short_and_long_rows() + [(1000, None), (1001, ""), (1002, "short")]
    steps, sums_of = [], secrets._sums_of
    monkeypatch.setattr(secrets, "_sums_of", lambda docs, network: steps.append(sums_of(docs, network)) or steps[-1])
    scanner = secrets.fit(documents(rows + rows[:50]).repartition(3))
    held = [zlib.crc32((t or "").encode()) % 10 < 3 for _, t in rows]
    copies = [1 + (i < 50) for i in range(len(rows))]
    texts = {k: [t for (_, t), h, n in zip(rows, held, copies, strict=True) if t and h == k for _ in range(n)] for k in (True, False)}
    x, secret = labelled_windows(texts[False])
    # each step has windows, and all steps have each window once, a secret in its three ways
    assert len(steps) == secrets.STEPS and all(s[0, -1] for s in steps)
    assert sum(s[:, -1] for s in steps).tolist() == [(~secret).sum(), 2 * secret.sum(), 3 * secret.sum()]
    # figures of the threshold are those of all windows set apart
    x, secret = labelled_windows(texts[True])
    taken = scanner.score(x) >= scanner.threshold - 1e-9
    assert taken[secret].mean() >= secrets.RECALL and scanner.recall == pytest.approx(taken[secret].mean())
    assert scanner.precision == pytest.approx(secret[taken].mean())
    assert (scanner.score(x[secret] * secrets.INSIDE) >= scanner.threshold - 1e-9).mean() >= secrets.RECALL


def test_pipeline_redacts_by_a_network_of_all_findings(spark, documents, monkeypatch):
    monkeypatch.setattr(secrets, "SAMPLE", 8)
    rows, seen = short_and_long_rows()[:200], []
    sums_of, counts_of = secrets._sums_of, secrets._counts_of

    def sums(docs, network):
        out = sums_of(docs, network)
        seen.append(out[0, -1])
        return out

    def counts(docs, network):
        out = counts_of(docs, network)
        seen.append(sum(n for (label, *_), n in out.items() if not label))
        return out

    monkeypatch.setattr(secrets, "_sums_of", sums)
    monkeypatch.setattr(secrets, "_counts_of", counts)
    monkeypatch.setattr(secrets, "STEPS", 2)
    got = corpus_pipeline.redact_secrets(spark, documents(rows), "").collect()
    assert len(got) == len(rows) and all("[secret]" in r.text for r in got)
    assert sum(seen) == (~labelled_windows([t for _, t in rows])[1]).sum()


def test_secret_gradients_are_those_of_the_loss_of_all_windows():
    texts = [t for _, t in short_and_long_rows()[:12]]
    x, secret = labelled_windows(texts)
    made, label, _ = secrets.other_ways(texts, secrets._labelled(texts))
    groups = [(x[~secret], -1), (made[label == 0], -1), (made[label == 1], 1)]
    rng = np.random.default_rng(5)
    network = secrets.train(*(np.concatenate(v) for v in ((x[secret], x[~secret][:50]), (np.ones(secret.sum(), int), np.zeros(50, int)))))
    sums = secrets.gradient_sums(texts, network)
    assert sums[:, -1].tolist() == [len(codes) for codes, _ in groups]
    # the sums don't depend on how texts are dealt over tasks
    assert np.allclose(sums, sum(secrets.gradient_sums([t], network) for t in texts))

    def losses(params):
        raw = [(secrets._forward(params, codes)[0], sign) for codes, sign in groups]
        return np.array([np.maximum(0, secrets.MARGIN - sign * logits).sum() for logits, sign in raw])

    for k, p in enumerate(network.params):
        way = rng.normal(size=p.shape)
        at = sum(q.size for q in network.params[:k])
        ends = [losses([q + s * way if j == k else q for j, q in enumerate(network.params)]) for s in (1e-6, -1e-6)]
        assert np.allclose(sums[:, at : at + p.size] @ way.ravel(), (ends[0] - ends[1]) / 2e-6, rtol=1e-3, atol=1e-3)


def test_redaction_replaces_spans_once(documents):
    docs = documents([(1, f'a token = "{"0f" * 20}" z'), (2, None), (3, "clean")]).withColumn("codes", F.lit(1))
    got = {r.doc_id: r for r in secrets.redact(docs, None).collect()}
    assert got[1].text == 'a [secret]" z' and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[3].text == "clean"


def test_secrets_without_findings_or_rows(documents):
    assert secrets.fit(documents([(1, "nothing here"), (2, None)])) is None
    empty = documents([])
    assert secrets.fit(empty) is None and secrets.scan(empty, None).collect() == []


# ----------------------------------------------------------------- divergence


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


QUALITY = [
    None, "", " ", "\n\n", "one", "a b c a b c", "l\nl\n l\nl ", "é ü # <b>\x0bx\x1cy\u2003z", "aaa " * 70, "x\n" * 60, "a\r\nb\r\na\r\n",
    " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i % 20}" for i in range(60)), "tail\ntail", "\ntail\n\ntail", "日本語 " * 10,
]


def test_base_counts_equal_brute_force():
    rng = random.Random(2)
    texts = QUALITY + ["".join(rng.choice("ab \n\t#é") for _ in range(rng.randrange(400))) for _ in range(80)]
    for size in (1 << 20, 64):
        got = []
        for part in slices(pa.array(texts, pa.string()), size):
            counts = divergence.base_counts(part, part.hashes())
            got += list(zip(*[c.tolist() for c in counts.values()], divergence.base_failed(counts).tolist()))
        assert got == [brute_quality(t) for t in texts]


def prose(rng, pool, n):
    return " ".join(rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choice("etaoinsr") for _ in range(6)) for _ in range(n))


def quality_corpus():
    rng = random.Random(3)
    pools = {"en": ["the", "of", "and", "to", "in"], "fr": ["le", "la", "de", "et", "un"]}
    rows = [(i, prose(rng, pools[lang := "en" if i % 3 else "fr"], 80 + i % 90), lang) for i in range(400)]
    junk = [(1000 + i, " ".join(w + "$$$" for w in prose(rng, pools["en"], 90).split())) for i in range(10)]
    menus = [(2000 + i, " | ".join("".join(rng.choice("etaoinsr") for _ in range(7)) for _ in range(90))) for i in range(10)]
    return rows, junk, menus


def test_divergence_drops_unlike_texts_and_keeps_clean_ones(documents):
    rows, junk, menus = quality_corpus()
    docs = documents(rows + [(*r, None) for r in junk + menus] + [(3000, "short text", None), (3001, None, "en"), (None, rows[0][1], None)])
    refs = divergence.fit_references(docs.withColumn("key", F.lit(1)))
    assert refs.languages == ["en", "fr"] and len(refs.words) <= 2 / divergence.COMMON
    got = {r.doc_id: r for r in divergence.judge(docs, refs).collect()}
    assert all(got[r[0]].kept for r in rows) and got[None].kept
    assert not any(got[r[0]].kept for r in junk + menus)
    assert got[3000].base_failed and not got[3000].kept and not got[3001].kept


def test_the_guard_decides_for_short_texts(documents):
    """Texts equally far from every language: the short one stays, the long one goes."""
    words = [f"w{i}" for i in range(500)]
    refs = divergence.References(["xx"], np.zeros((1, len(divergence.CLASSES))), np.zeros(0, np.uint64), np.ones((1, 1)))
    texts = {n: " ".join(words[:n]) for n in (52, 120, 500)}
    [part] = slices(pa.array(list(texts.values())))
    refs.classes = (divergence.class_counts(part) / divergence.class_counts(part).sum(axis=1, keepdims=True)).mean(axis=0, keepdims=True)
    short, middle, long = divergence.limits(np.array([52, 120, 500]))[1]
    assert long == divergence.WORD_LIMIT < middle < short
    # one common word that no text has, with the share that puts all texts between the limits
    refs.words = np.array([1], np.uint64)
    between = (short + divergence.WORD_LIMIT) / 2
    low, high = 0.0, 1.0
    for _ in range(50):
        share = (low + high) / 2
        refs.shares = np.array([[share, 1 - share]])
        far = divergence.distances(part, part.hashes(), refs)[1][0, 0]
        low, high = (share, high) if far < between else (low, share)
    got = {r.doc_id: r for r in divergence.judge(documents(list(texts.items())), refs).collect()}
    assert len({round(r.word_distance, 9) for r in got.values()}) == 1
    assert got[52].kept and not got[500].kept


def test_every_language_is_a_reference(documents):
    """A dozen texts of a third language are judged by it; with a single one it leans on what all share."""
    rows, junk, _ = quality_corpus()
    rng = random.Random(5)
    few = [(6000 + i, prose(rng, ["il", "che", "non", "per", "una"], 90), "it") for i in range(12)]
    refs = divergence.fit_references(documents([*rows, *few, (7000, prose(rng, ["az", "egy"], 60), "hu")]))
    assert refs.languages == ["en", "fr", "hu", "it"]
    assert np.allclose(refs.shares.sum(axis=1), 1) and np.allclose(refs.classes.sum(axis=1), 1)
    got = {r.doc_id: r for r in divergence.judge(documents([*rows, *few, *[(*r, None) for r in junk]]), refs).collect()}
    assert all(got[r[0]].kept for r in [*rows, *few]) and not any(got[r[0]].kept for r in junk)


def test_distance_equals_the_definition():
    rng = np.random.default_rng(0)
    p, q = rng.dirichlet(np.ones(6), 3), rng.dirichlet(np.ones(6), 2)
    p[0, :3] = 0
    p[0] /= p[0].sum()
    rows, bins = np.nonzero(p)
    got = divergence.distance(rows, bins, p[rows, bins], q, 3)
    kl = lambda a, b: sum(x * np.log2(x / y) for x, y in zip(a, b) if x > 0)
    for i in range(3):
        for j in range(2):
            m = (p[i] + q[j]) / 2
            assert got[i, j] == pytest.approx(np.sqrt((kl(p[i], m) + kl(q[j], m)) / 2))


def test_divergence_without_references_or_rows(documents):
    assert divergence.fit_references(documents([(1, "few words", "en")])) is None
    assert divergence.judge(documents([]), None).collect() == []
    assert [r.kept for r in divergence.judge(documents([(1, " ".join(f"w{i}" for i in range(60)))]), None).collect()] == [True]


# ---------------------------------------------------------------- language ID


def language_rows(n=240):
    rng = random.Random(5)
    pools = {"en": ["the", "this", "with", "which", "house"], "de": ["und", "nicht", "der", "schön", "über"], "es": ["que", "los", "ción", "para", "ñoño"]}
    rows = []
    for i in range(n):
        lang = list(pools)[i % 3]
        rows.append((i, " ".join(rng.choice(pools[lang]) for _ in range(rng.choice([8, 60, 400]))), lang))
    return rows


def test_language_held_out_accuracy(documents):
    rows = language_rows()
    docs = documents(rows + [(900, None, "en"), (901, "123 ...", None), (902, "", "de"), (None, "und nicht der und über", "en")])
    net = language_id.fit(docs)
    frame = docs.select("doc_id", "text", F.lit("x").alias("score"), F.lit(1).alias("window"))
    got = {r.doc_id: r for r in language_id.predict_languages(frame, net).withColumn("held", language_id.held_out()).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(got[r[0]].held == (zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in rows)
    assert len(held) > 20 and np.mean([got[i].lang_pred == lang for i, _, lang in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and not got[None].held and got[None].lang_pred == "de"


def test_language_tables_give_the_network(documents):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 256, (9, language_id.WINDOW)).astype(np.uint8)
    net = language_id.train(x, np.arange(9) % 2, ["a", "b"], epochs=1)
    emb = net.embedding[x]
    features = []
    for width, w, b in zip(language_id.WIDTHS, net.filters, net.biases):
        cols = np.stack([emb[:, i : i + width].reshape(9, -1) for i in range(language_id.WINDOW - width + 1)], 1)
        features.append(np.maximum((cols @ w).max(axis=1) + b, 0))
    z = np.exp(np.concatenate(features, 1) @ net.dense + net.dense_bias)
    assert np.allclose(language_id.predict(net, net.tables(), x), z / z.sum(axis=1, keepdims=True), atol=1e-4)


def test_language_windows_cover_whole_texts():
    for n in (1, 255, 256, 257, 1000, 5120):
        data = np.arange(n) % 251
        seen = language_id.text_windows(data.astype(np.uint8))
        assert seen.shape[1] == language_id.WINDOW
        if n >= language_id.WINDOW:
            assert seen.shape[0] == -(-n // language_id.WINDOW) and (seen[-1] == data[-language_id.WINDOW :]).all()


def test_language_without_labels_or_rows(documents):
    docs = documents([(1, "some text"), (2, None)])
    assert language_id.fit(docs) is None
    assert [r.lang_pred for r in language_id.predict_languages(docs, None).collect()] == ["und", "und"]
    assert language_id.predict_languages(documents([]), None).collect() == []
