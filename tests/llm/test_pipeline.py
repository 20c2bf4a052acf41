"""The pipeline next to a plain version, document by document."""

from __future__ import annotations

import hashlib
import struct

import corpus_pipeline
import numpy as np
from test_structured_operators import brute_components
from test_text_operators import DATA, brute_hits

from talkloom.llm import langid, quality, queries


def plainly_known(raw, trees):
    """Letters with no digit beside them, by segments, each in its cheapest language."""
    letter = [chr(b).isascii() and chr(b).isalpha() or b >= 128 for b in raw]
    digit = [48 <= b <= 57 for b in raw] + [False]
    letter = [x and not digit[i + 1] and not (i and digit[i - 1]) for i, x in enumerate(letter)]
    s = [0] * langid.ORDER + [int(trees.symbol[b]) for b in raw]
    history = [np.array([s[i + langid.ORDER - k] if i >= k else 0 for i in range(len(raw))]) for k in range(1, langid.ORDER + 1)]
    bits = langid.symbol_bits(history, np.array(s[langid.ORDER :]), trees)
    c = sum(sum(letter) >= x for x in langid.CLASSES) - 1
    cost = allowed = 0.0
    for lo in range(0, len(raw), langid.SEGMENT):
        at = [i for i in range(lo, min(len(raw), lo + langid.SEGMENT)) if letter[i]]
        if at:
            sums = bits[at].sum(axis=0, dtype=float)
            cost += sums.min()
            allowed += trees.limits[sums.argmin(), max(c, 0)] * len(at)
    return c < 0 or cost <= allowed


def plain_run(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = docs.collect()
    trees = langid.fit(docs, limits=True)
    kept = []
    for r in rows:
        raw = (r["text"] or "").encode()
        if langid.has_letter(raw) and plainly_known(raw, trees):
            kept.append(r)
    model = quality.fit(spark.createDataFrame(kept, docs.schema), spark.read.parquet(f"{DATA}/labels.parquet"))
    features = [(quality.text_features(r["text"].encode()), quality.meta_features(r["source"], r["lang"], r["n_chars"])) for r in kept]
    scores = model.scores(np.stack([t for t, _ in features]), np.stack([m for _, m in features]))[2]
    kept = [r for r, s in zip(kept, scores, strict=True) if s >= quality.THRESHOLD]
    groups = brute_components([(r["doc_id"], r["text"]) for r in kept])
    kept = [r for r in kept if groups[r["doc_id"]][1] == r["doc_id"]]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {h[0] for h in brute_hits([(r["doc_id"], r["text"]) for r in kept], items) if h[5]}
    kept = [r for r in kept if r["doc_id"] not in hit]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(f"{queries.TOKENIZERS}/word_bpe_49k.json")
    library.no_truncation()
    out = set()
    for r in kept:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        out.add((r["doc_id"], len(ids), digest, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return out


def test_pipeline_matches_plain_version(spark):
    got = corpus_pipeline.run(spark, DATA).collect()
    want = plain_run(spark)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert 0.5 * spark.read.parquet(f"{DATA}/documents.parquet").count() < len(got)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, docs, DATA).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding",
    ]
