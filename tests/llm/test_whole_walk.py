"""Walks of fingerprints reach the end of every text."""

from __future__ import annotations

import random

import numpy as np

from talkloom.llm import fingerprint


def plain_print(text):
    """Fingerprint bits by a walk of one text, character by character."""
    t, walked, at, j = fingerprint.tables(), [], 0, 0
    letters = [*fingerprint.classes(text).tolist(), fingerprint.END]
    while letters[at] != fingerprint.END:
        walked.append(letters[at])
        at += t["walk"][j % fingerprint.PERIOD][letters[at]]
        j += 1
    walked = walked or [fingerprint.END]
    places = [p[p < len(walked)][-1] for p in fingerprint.records(1 << 20)]
    return len(walked), [t["symbol"][k][walked[p]] for k, p in enumerate(places)]


def test_fingerprints_walk_whole_texts():
    rng = random.Random(7)
    texts = ["", "a", *("".join(rng.choice("abcdefgh éß漢") for _ in range(rng.randrange(1, 900))) for _ in range(150))]
    got = fingerprint.fingerprints(texts)
    plain = [plain_print(x) for x in texts]
    assert any(n > 2 * len(x) for (n, _), x in zip(plain, texts, strict=True))
    assert np.array_equal(got, np.array([bits for _, bits in plain]))
