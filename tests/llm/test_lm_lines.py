"""Bits are worked on line by line: each line hashed once, each bit in the slot that the node and the way to it give."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from retailflow.llm import lm_text


def test_texts_are_split_as_one_by_one():
    rng = random.Random(4)
    parts = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "a", "B", "É", "\x1c", "\x85", " ", "Zz"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)] + [None, "", " \n"]
    got = lm_text.split(pa.array(texts, pa.string())).to_pylist()
    assert [[w.encode() for w in words] for words in got] == [lm_text.tokens_of(t) for t in texts]


def test_lines_hold_every_bit_once_and_in_its_slot():
    words = [b"w%d" % i for i in range(70)]
    code = lm_text.Code(words, [2 ** (i % 9) + 1 for i in range(70)], 3)
    rng = random.Random(5)
    tokens = [rng.choice([*words, b"rare", "selten é".encode(), b""]) for _ in range(300)]
    ids, contexts = lm_text.encoded(tokens, [200, 100], code.index(), code.hashes)
    expected = []
    for t, i in enumerate(ids):
        start, way = code.starts[i], 1
        for depth in range(code.lengths[i]):
            if depth % 4 == 0:
                line, way = int(code.nodes[start + depth]), 1
            bit = int(code.bits[start + depth])
            slots = [((int(c) + line) * int(lm_text.MULTIPLY) % 2**64 >> 64 - lm_text.SLOTS) ^ way for c in contexts[:, t]]
            expected.append((t, depth, int(code.nodes[start + depth]), slots, bit))
            way = 2 * way + bit
    token, place, hashed = lm_text.lines(ids, contexts, code)
    assert len(token) == sum((int(n) + 3) // 4 for n in code.lengths[ids])
    step = lm_text.bitwise(code.steps, place).astype(np.int64)
    got = [(int(token[b // 4]), int(s >> 5), int(code.at[place[b // 4], b % 4]),
            [int(h[b // 4]) ^ (int(s) >> 1 & 15) for h in hashed], int(s & 1))
           for b, s in enumerate(step) if s != lm_text.LACKING]
    assert got == expected
    sides = lm_text.lines(ids, contexts, code, True)[2]
    assert (sides == hashed * 2).all()


def test_words_hash_by_all_their_bytes():
    words = [b"", b"a", b"aa", b"ab", b"ba", b"a" * 5000, b"a" * 4999 + b"b", "é".encode()]
    whole = lm_text.hashed_words(pa.array(words, pa.binary()))
    assert len(set(whole.tolist())) == len(words)
    assert (lm_text.hashed_words(pa.array([b"x", *words], pa.binary()).slice(1)) == whole).all()
