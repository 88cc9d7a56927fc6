"""Unlike texts stay unlike: the Thue-Morse pair, whose polynomial hashes modulo a power of two agree."""

import numpy as np
import pyarrow as pa

from plumbline.llm import divergence, near_dedup, sampled_pieces
from plumbline.llm.near_dedup import near_components, sizes_and_keys
from plumbline.llm.shared import bytes_hash, sequence_hash, slices
from plumbline.llm.substring_dedup import substring_dedup

BITS = [bin(i).count("1") % 2 for i in range(2048)]
ONE = "".join("ab"[b] for b in BITS)
OTHER = "".join("ba"[b] for b in BITS)


def test_hashes_tell_the_pair_apart():
    data = np.frombuffer((ONE + OTHER).encode(), np.uint8)
    for n in (8, 16, 64, 1024, 2048):
        for key in range(3):
            a, b = bytes_hash(data, np.array([0, 2048]), np.array([n, 2048 + n]), key).tolist()
            assert a != b
    words = bytes_hash(data, np.arange(2), np.arange(2) + 1)
    one, other = words[BITS], words[1 - np.array(BITS)]
    both = np.concatenate([one, other])
    assert len(set(sequence_hash(both, np.array([0, 2048]), np.array([2048, 4096])).tolist())) == 2


def test_equal_ranges_hash_alike_wherever_they_stand():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 100, 50).astype(np.uint8)
    for size in (0, 1, 7, 8, 9, 16, 17, 40):
        found = set()
        for before in range(9):
            data = np.concatenate([rng.integers(0, 255, before).astype(np.uint8), text[:size], rng.integers(0, 255, 9).astype(np.uint8)])
            found.add(int(bytes_hash(data, np.array([before]), np.array([before + size]))[0]))
        assert len(found) == 1


def test_substring_dedup_keeps_the_unlike_word(documents):
    rest = [f"w{i}" for i in range(12)]
    got = {r.doc_id: r for r in substring_dedup(documents([(1, " ".join([ONE, *rest])), (2, " ".join([OTHER, *rest])), (3, " ".join([OTHER, *rest]))])).collect()}
    assert [got[i].n_removed for i in (1, 2, 3)] == [0, 0, 13]


def test_unlike_lines_are_no_repetition():
    [part] = slices(pa.array([f"{ONE}\n{OTHER}\n{ONE}"]))
    assert divergence.base_counts(part, part.hashes())["n_dup_lines"].tolist() == [1]


def test_near_components_do_not_link_the_pair(documents):
    text = lambda word: " ".join([word, *["x"] * 3])
    got = {r.doc_id: r.component_id for r in near_components(documents([(1, text(ONE)), (2, text(OTHER)), (3, text(OTHER)), (4, ONE), (5, OTHER)])).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5}


def test_sets_that_share_a_name_are_told_apart(monkeypatch):
    """With names of four bits many sets share one; their checks part them."""
    texts = [" ".join(f"{c}{i}" for i in range(12)) for c in "abcdefghijklmnopqrstuvwxyz"]
    monkeypatch.setattr(near_dedup, "UNUSED_BITS", np.uint64(60))
    clashing = np.unique(names(texts, np.zeros(0, np.uint64)))
    assert len(clashing) <= 16
    apart = names(texts, clashing)
    assert len(set(apart)) == len(texts) and apart == names(texts * 2, clashing)[len(texts) :]


def names(texts, clashing):
    [part] = slices(pa.array(texts))
    return sizes_and_keys(part, 5, clashing)[1].tolist()


def test_sampled_units_of_one_hash_stay_apart(monkeypatch):
    pieces = sampled_pieces.Pieces(None, 1.0)

    def encode(texts):
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
        ids, at = sampled_pieces.encode_slice(data, bounds, np.arange(len(texts)).astype(np.uint64), pieces)
        return sampled_pieces.decode_slice(ids, at, pieces)[0].tobytes().decode()

    assert encode([ONE, OTHER]) == ONE + OTHER
    # even where all units of one length share a hash
    monkeypatch.setattr(sampled_pieces, "bytes_hash", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    for texts in (["some words here", "with other units", OTHER], ["here some more words", ONE, "é日本 ab ba"]):
        assert encode(texts) == "".join(texts)
