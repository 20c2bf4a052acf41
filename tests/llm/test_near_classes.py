"""Classes of near fingerprints next to brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from test_text_operators import DATA
from test_whole_walk import plain_print

from talkloom.llm import fingerprint, hubs, queries


def near_pairs(prints, least):
    """All pairs of at least that likeness, whatever buckets they share."""
    ids = [i for i, _ in prints]
    bits = np.array([np.unpackbits(np.frombuffer(bytes.fromhex(p), np.uint8)) for _, p in prints], np.int32)
    apart = (bits[:, None, :] != bits[None, :, :]).sum(axis=2)
    return [(ids[a], ids[b]) for a in range(len(ids)) for b in range(a + 1, len(ids)) if 1 - 2 * apart[a, b] / fingerprint.BITS >= least]


def groups(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def classes_of(spark, prints):
    rows = fingerprint.near_classes(spark.createDataFrame(prints, "doc_id long, fingerprint string")).collect()
    return {i: i for i, _ in prints} | {r["id"]: r["near_class"] for r in rows}


@pytest.mark.parametrize(("rounds", "block"), [(2, 1024), (0, 7), (1, 1024)])
def test_near_classes_connect_all_near_pairs_of_a_bucket(spark, monkeypatch, rounds, block):
    monkeypatch.setattr(hubs, "ROUNDS", rounds)
    monkeypatch.setattr(fingerprint, "BLOCK", block)
    rng = np.random.default_rng(5)
    prints = []
    for family in range(4):
        start = rng.integers(0, 2, fingerprint.BITS, dtype=np.uint8)
        for k in range(60):
            copy = start ^ (rng.random(fingerprint.BITS) < 0.06)
            prints.append((100 * family + k, fingerprint.to_hex(copy[None])[0]))
    shape = fingerprint.band_shape(len(prints))
    keys = {i: fingerprint.band_keys(p, *shape) for i, p in prints}
    near = near_pairs(prints, 0.8)
    shared = [(a, b) for a, b in near if any(x == y for x, y in zip(keys[a], keys[b], strict=True))]
    assert len(shared) / len(near) >= 0.9
    assert classes_of(spark, prints) == groups([i for i, _ in prints], shared)


def test_recall_over_lone_edited_pairs(spark):
    """Each text and one edited copy, so no third text can connect them."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(300, 900))) for _ in range(200)]
    for k, t in enumerate(texts[:200]):
        for _ in range(1 + k % 6):
            at = rng.randrange(len(t))
            t = t[:at] + rng.choice(("", "zz", "q")) + t[at + rng.randint(0, 1) :]
        texts.append(t)
    prints = list(enumerate(fingerprint.to_hex(fingerprint.fingerprints(texts))))
    near = near_pairs(prints, fingerprint.NEAR)
    got = classes_of(spark, prints)
    assert len(near) >= 100
    assert sum(got[a] == got[b] for a, b in near) / len(near) >= 0.9
    assert set(groups(list(got), near).items()) >= {(i, c) for i, c in got.items() if i == c}


def test_without_id_and_repeated_ids(spark):
    same = "ab" * 32
    rows = [(None, same[:-1] + "a"), (3, same), (4, same[:-1] + "8"), (4, "00" * 32), (9, "00" * 32), (11, "f0" * 32)]
    found = fingerprint.near_classes(spark.createDataFrame(rows, "doc_id long, fingerprint string")).collect()
    assert {(r["id"], r["near_class"]) for r in found} == {(3, 3), (4, 3), (9, 3)}
    one = fingerprint.with_near_class(spark.createDataFrame(rows, "doc_id long, fingerprint string")).collect()
    assert sorted((r["doc_id"] or 0, r["near_class"] or 0) for r in one) == [(0, 0), (3, 3), (4, 3), (4, 3), (9, 3), (11, 11)]


def test_query_matches_brute_force(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = queries.op10_fingerprint(spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        bits = plain_print(docs[r["doc_id"]])[1]
        assert r["fingerprint"] == np.packbits(bits).tobytes().hex()
    near = near_pairs([(r["doc_id"], r["fingerprint"]) for r in rows], fingerprint.NEAR)
    got = {r["doc_id"]: r["near_class"] for r in rows}
    want = groups(list(got), near)
    assert sum(got[a] == got[b] for a, b in near) >= 0.9 * len(near)
    assert all(want[i] == want[c] for i, c in got.items())  # nothing else is connected
