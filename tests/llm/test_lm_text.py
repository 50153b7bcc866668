"""Codes, contexts over words, and that a text's score depends on the order of its words."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from retailflow.llm import lm_score, lm_text

SCHEMA = "doc_id long, text string"


def code_of(words: list[bytes], outside: int = 3) -> lm_text.Code:
    return lm_text.Code(words, [len(words) - i for i in range(len(words))], outside)


def mixer_of(code: lm_text.Code) -> lm_text.TextMixer:
    rng = np.random.default_rng(1)
    mixer = lm_text.TextMixer(code, [rng.integers(0, 225, 1 << lm_text.SLOTS).astype(np.uint8) for _ in lm_text.BEFORE])
    mixer.refine = rng.integers(1, 50, mixer.refine.shape).astype(float)
    mixer.refine[1] += mixer.refine[0]
    return mixer


def test_codes_are_prefix_free_and_every_bit_has_its_node():
    code = code_of([b"w%d" % i for i in range(50)])
    paths = ["".join(map(str, code.bits[s:s + n])) for s, n in zip(code.starts, code.lengths)]
    assert len(set(paths)) == 51 and sum(2.0 ** -len(p) for p in paths) == 1
    node_of = {}
    for path, start in zip(paths, code.starts):
        for depth in range(len(path)):
            assert node_of.setdefault(path[:depth], code.nodes[start + depth]) == code.nodes[start + depth]
    assert len(set(node_of.values())) == len(node_of) == 50


def test_symbols_after_any_words_add_up():
    words = [b"w%d" % i for i in range(20)]
    mixer = mixer_of(code_of(words))
    for before in ([], [b"w3"], [b"w3", b"unknown"], [b"w1", b"w2", b"w3", b"w4"]):
        chances = []
        for word in [*words, b"other"]:
            tokens = [*before, word]
            chances.append(10 ** mixer.score(*lm_text.encoded(tokens, [len(tokens)], mixer.code.index(), mixer.code.hashes))[-1])
        assert sum(chances) == pytest.approx(1, abs=1e-4)


def test_contexts_run_over_words_and_end_with_the_text():
    code = code_of([b"", b"a", b"b", b"c"])

    def contexts(*texts):
        tokens = [t for text in texts for t in text]
        return lm_text.encoded(tokens, [len(t) for t in texts], code.index(), code.hashes)[1]

    one, two = contexts([b"a", b"b", b"c", b""])[:, 2], contexts([b"c", b"b", b"c", b""])[:, 2]
    # Equal with one word of context, different with two or three words and with the second word before.
    assert [bool(x == y) for x, y in zip(one, two)] == [True, False, False, False]
    rare = [contexts([w, b"c", b""])[0, 1] for w in (b"rare", b"other", b"rare")]
    assert rare[0] == rare[2] != rare[1]
    both = contexts([b"a", b"b", b""], [b"b", b"c", b""])
    assert (both == np.hstack([contexts([b"a", b"b", b""]), contexts([b"b", b"c", b""])])).all()


def test_slices_do_not_matter(monkeypatch):
    rng = random.Random(2)
    words = [b"w%d" % i for i in range(30)]
    mixer = mixer_of(code_of(words))
    tokens = [rng.choice([*words, b"rare"]) for _ in range(500)]
    given = lm_text.encoded(tokens, [500], mixer.code.index(), mixer.code.hashes)
    whole = mixer.score(*given)
    monkeypatch.setattr(lm_text, "SLICE", 7)
    assert mixer.score(*given) == pytest.approx(whole)


def test_counts_beyond_two_bytes_are_exact():
    counts, expected = lm_text.Counts(), Counter()
    for _ in range(9):
        places = np.array([5] * 30_000 + [8] * 20_000 + [2 * lm_text.BLOCK + 1])
        counts.add(places)
        expected.update(places.tolist())
    got = {2 * at + i: int(n) for at, data in counts.blocks() for i, n in enumerate(lm_text.Counts.unpacked(data).reshape(-1)) if n}
    assert got == dict(expected)


def test_the_order_of_words_counts(spark):
    rng = random.Random(3)
    follow = {f"w{i}": f"w{(7 * i + 3) % 40}" for i in range(40)}

    def chain(n):
        word, out = rng.choice(list(follow)), []
        for _ in range(n):
            out.append(word)
            word = follow[word]
        return out

    docs = [(i, " ".join(chain(60))) for i in range(300)]
    held = [i for i in range(1000, 1200) if lm_score.held_out(i)][:2]
    text = chain(60)
    docs += [(held[0], " ".join(text)), (held[1], " ".join(text[::-1]))]
    got = {r.doc_id: r for r in lm_score.score_documents(spark.createDataFrame(docs, SCHEMA)).collect()}
    right, wrong = got[held[0]], got[held[1]]
    assert right.base_score == pytest.approx(wrong.base_score)
    assert right.score > 0.6 * wrong.score and right.score > 0.6 * right.base_score


def test_score_is_the_probability_of_the_whole_text(spark):
    docs = [(i, "one two three " * 5 + "four") for i in range(30)]
    held = [i for i in range(1000, 1200) if lm_score.held_out(i)][:2]
    docs += [(held[0], "one two qzx"), (held[1], "one two qzxqzxqzxqzxqzxqzx")]
    got = {r.doc_id: r.score for r in lm_score.score_documents(spark.createDataFrame(docs, SCHEMA)).collect()}
    # A longer word that no training text holds costs more: it is spelled, not priced as one of a class.
    assert got[held[1]] < got[held[0]] - 5
