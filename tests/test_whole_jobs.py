"""Registered queries that do the whole job where an older one takes less."""

from __future__ import annotations

import numpy as np
import pytest
from test_queries import DATA

from talkloom.operators import resampling
from talkloom.plans import parity, registry


def test_resampling_takes_all_draws(spark):
    """These tables fit a block, so its keys and hashes are all there is to the picks and signs."""
    d = np.array([r["d"] for r in parity._diffs(spark, DATA).orderBy("pos").collect()])
    keys = resampling.stream_keys(42, 0, np.arange(10_000))
    places = np.arange(len(d), dtype=np.uint32) * np.uint32(resampling.GOLDEN)
    means = np.sort(d[resampling.mixed(keys[:, None] + places) % np.uint32(len(d))].mean(axis=1))
    ci = registry.queries()["bootstrap_ci"](spark, DATA).first()
    assert len(means) == 10_000 and (ci["low"], ci["high"]) == pytest.approx((means[250], means[9749]), abs=2e-6)
    words = resampling.mixed(resampling.stream_keys(42, 0, np.arange(313))[:, None] + places)
    signs = np.array([1 - 2 * (words >> np.uint32(k) & np.uint32(1)).astype(int) for k in range(32)]).transpose(1, 0, 2).reshape(-1, len(d))[:10_000]
    tenths = np.round(d * 10).astype(int)
    hits = int((abs((tenths * signs).sum(axis=1)) >= abs(tenths.sum())).sum())
    p = registry.queries()["permutation_p"](spark, DATA).first()
    assert (p["hits"], p["p"]) == (hits, pytest.approx(hits / 10_000))


def test_prompts_and_inspections_hold_whole_texts(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    prompts = registry.queries()["render_judge_prompt"](spark, DATA).collect()
    assert len(prompts) == len(texts) and all(f"Gold: {texts[r['doc_id']]}\nA: " in r["prompt"] for r in prompts)
    failed = registry.queries()["inspect_failed"](spark, DATA).collect()
    assert any(len(r["label"]) > 80 for r in failed)
    for r in failed:
        assert r["label"] == (texts[int(r["request_id"])] or "(no label)")
        assert r["transcript"] == (texts[int(r["request_id"])].strip() or "(failed to extract)")
