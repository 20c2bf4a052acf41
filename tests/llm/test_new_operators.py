"""Fill-in-middle, ranked search, exact deduplication: plain versions and edges."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from talkloom.llm import exact_dedup, fill_middle, queries, ranked_search

DATA = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# ---- op11 ----


def plain_fill(doc, text):
    """The contract, character by character."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 20 else "psm"
    return n, form, len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"


def odd_texts():
    dice = random.Random(7)
    signs = ["<", "P", ">", "S", "M", "é", "𝔸", "\n", "\0", " ", "word", "<S", "<P", "S>", "­"]
    texts = ["".join(dice.choice(signs) for _ in range(dice.randrange(1, 30))) for _ in range(300)]
    return [None, "", "<", "a<P>b", "<M>", "é" * 3, "word " * 200_000, "x" * 1_000_000, *texts]


def test_fill_middle_is_the_plain_one_and_is_undone(spark):
    texts = odd_texts()
    rows = [(i if i else None, t, i) for i, t in enumerate(texts)] + [(5, "same", 1), (5, "same", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N long")
    made = fill_middle.fill_middle(docs, keep=["doc_id", "N", "text"])
    assert made.columns == ["doc_id", "N", "text", "n_", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]
    got = made.select("*", fill_middle.restored("output", "form").alias("back")).collect()
    assert len(got) == len(rows)
    forms = collections.Counter()
    for r in got:
        want = plain_fill(r["doc_id"], r["text"])
        assert (r["n_"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["back"]["restored"] == (r["text"] or "")
        assert r["back"]["restored_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
        assert r["output_sha256"] == hashlib.sha256(want[-1].encode()).hexdigest()
        forms[r["form"]] += 1
    assert set(forms) == {"plain", "psm", "spm"}
    assert fill_middle.fill_middle(docs.limit(0)).count() == 0


def test_fill_middle_refuses_other_outputs():
    for output, form in (("abc", "psm"), ("<P>a<M>b", "psm"), ("<P>a<S>b<M>c", "spm")):
        with pytest.raises(ValueError):
            fill_middle.restore_text(output, form)


# ---- op12 ----


def plain_search(docs, items, k=50):
    """Every document scored for every item."""
    counts = [(d, collections.Counter(WORD.findall(lower(t or "")))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    total, n_docs = sum(c.total() for _, c in counts), len(counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counts:
            m = 100 - 50 + (50 * c.total() * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(WORD.findall(lower(text or ""))) if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, rank, None if absent else d, -s) for rank, (s, absent, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def zipf_texts(seed, n, words=60):
    dice = np.random.default_rng(seed)
    return [" ".join(f"w{x % 97}" for x in dice.zipf(1.3, dice.integers(1, words))) for _ in range(n)]


@pytest.mark.parametrize("shard", [(1 << 14, 1 << 25), (7, 1 << 25), (1 << 14, 200)])
def test_search_is_the_plain_one(spark, shard):
    texts = zipf_texts(1, 900) + ["tie tie"] * 90 + ["W5 ÉCOLE école W5", None, "", "...", "w1 " * 30_000]
    docs = [(i if i % 50 else None, t) for i, t in enumerate(texts, 1)] + [(3, texts[2]), (3, "w9")]
    items = [(0, "w1 w2 w3 W50"), (1, "tie"), (2, None), (3, "unknown"), (4, "École w5"), (5, " ".join(f"w{i}" for i in range(97))), (5, "w90"), (None, "w91")]
    table = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").repartition(3)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    index = ranked_search.build_index(table, None, "doc_id", "text", *shard)
    for block in (1 << 20, 10) if shard[1] == 200 else (1 << 20,):
        got = ranked_search.search(index, asked, block_terms=block)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == plain_search(docs, items)
    # another set of items, without indexing anew
    assert sorted(map(tuple, ranked_search.search(index, asked.where("item_id = 0"), k=3).collect()), key=repr) == plain_search(docs, items[:1], 3)


def test_shards_are_written_and_read_one_at_a_time(spark, tmp_path):
    """A task with many shards holds one of them: each is a file and a batch of its own."""
    docs = spark.createDataFrame(list(enumerate(zipf_texts(2, 300))), "doc_id long, text string").repartition(2)
    index = ranked_search.build_index(docs, str(tmp_path / "i"), docs_of_shard=20)
    batches = index.shards.coalesce(1).mapInArrow(lambda bs: (pa.record_batch([pa.array([b.num_rows])], ["n"]) for b in bs), "n long")
    assert {r["n"] for r in batches.collect()} == {1}
    assert len(list((tmp_path / "i/shards").glob("part-*"))) == index.shards.count() >= 15


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("doc_id > 1"), items.limit(0))):
        assert ranked_search.search(ranked_search.build_index(d), i).collect() == []


def test_reading_stops_once_the_threshold_is_below_the_best():
    """Few of the entries are read, and ties with the last place are not lost."""
    texts = [f"rare{i % 500} common" for i in range(5000)] + ["rare1 rare1 rare1 rare1 common common"] * 60
    row = ranked_search.shard_row(pa.array(range(len(texts))), [t.encode() for t in texts], len(texts), 10_000 + 360)
    shard = ranked_search.Reader(row, 0, pa.array(["absent", "common", "rare1"]))
    docs, scores, read = shard.best(np.array([0, 1, 2]), np.array([9, 1, 6000]), 50)
    assert docs.tolist() == list(range(5000, 5050)) and len(set(scores.tolist())) == 1
    assert read < 600
    assert not shard.weight.any()


def test_shards_hold_words_as_they_are(monkeypatch):
    monkeypatch.setattr(ranked_search, "PIECE", 16)
    texts = [None, "", " .. ", "A b-a", "\u00e9 \u00e9\u00e9 \u0000A", "z" * 50, " x ", "w" * 3 + "\n"]
    raw = [t if t is None else t.encode() for t in texts]
    words = [WORD.findall(lower(t or "")) for t in texts]
    got = [r for b in ranked_search.totals_rows(iter([pa.record_batch([pa.array(texts)], ["text"])])) for r in b.to_pylist()]
    assert got == [{"n_docs": 5, "total": sum(map(len, words)), "bytes": sum(len(r or b"") for r in raw)}]
    row = ranked_search.shard_row(pa.array(range(8)), raw, 5, sum(map(len, words))).to_pylist()[0]
    held = [i for i, w in enumerate(words) if w]
    assert row["doc_ids"] == held
    for k, i in enumerate(held):
        terms = [row["vocabulary"][t] for t in row["terms"][row["starts"][k] : row["starts"][k + 1]]]
        assert sorted(terms) == sorted(set(words[i]))
    assert dict(zip(row["vocabulary"], row["counts"])) == collections.Counter(t for w in words for t in set(w))
    assert ranked_search.shard_row(pa.array([1]), [b"..."], 1, 1) is None


def test_impacts_beyond_64_bits():
    n = np.array([1 << 40], np.int64)
    got = ranked_search.impacts_of(np.array([3]), n, 1 << 20, 1 << 50)
    m = 50 + (50 * (1 << 40) * (1 << 20)) // (1 << 50)
    assert got.tolist() == [3_000_000_000 // (3000 + 20 * m)]


# ---- op13 ----


def plain_groups(rows):
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[lower(t or "")].append(d)
    out = []
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        stay = True
        for d in ids:
            out.append((d, top, len(ids), d == top and stay, hashlib.sha256(t.encode()).hexdigest()))
            stay = stay and d != top
    return sorted(out, key=repr)


def copies():
    texts = ["Hot Copy", None, "", "É a", "é a", "İ", "x" * 200_000, "lone"]
    rows = [(i, ("HOT copy" if i % 2 else "Hot Copy") if i % 3 == 0 else f"text {i % 1500}") for i in range(3000)]
    rows += [(10_000 + i, t) for i, t in enumerate(texts)] + [(77_777, "same"), (77_777, "SAME"), (None, "nameless"), (None, "nameless"), (None, "other"), (4, "OTHER")]
    return rows


@pytest.mark.parametrize("max_bits", [exact_dedup.MAX_BITS, 1 << 14])
def test_exact_groups_are_the_plain_ones(spark, max_bits):
    rows = copies()
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, KEPT long").repartition(7)
    got = exact_dedup.exact_groups(docs, max_bits=max_bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_groups(rows)
    whole = exact_dedup.exact_groups(docs, keep=docs.columns, max_bits=max_bits)
    assert whole.columns == ["doc_id", "text", "KEPT", "keep_id", "group_size", "kept_", "text_sha256"]
    stay = exact_dedup.deduplicate(docs, max_bits=max_bits)
    assert stay.columns == docs.columns and stay.count() == sum(r[3] for r in plain_groups(rows))
    assert {(r["doc_id"], r["text"]) for r in stay.collect()} <= set(rows)


def test_exact_groups_of_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0
    assert [tuple(r)[:4] for r in exact_dedup.exact_groups(docs).collect()] == [(1, 1, 1, True)]


def test_filter_passes_nearly_all_single_digests_and_no_repeated_one(spark, tmp_path):
    single = spark.range(40_000).selectExpr("xxhash64(id) as digest", "pmod(xxhash64(id, 1), 10) as segment")
    twice = single.where("pmod(digest, 20) = 0")
    rows = single.union(twice).repartition(9)
    test = exact_dedup.possibly_repeated(rows, str(tmp_path / "f"))
    words = spark.read.parquet(str(tmp_path / "f"))
    tested = rows.join(words, "segment", "left").select("digest", test.alias("maybe"))
    assert tested.where("pmod(digest, 20) = 0 and not maybe").count() == 0
    assert tested.where("pmod(digest, 20) <> 0 and maybe").count() < 0.02 * 40_000


@pytest.mark.parametrize("name", ["op11_fill_middle", "op12_ranked_search", "op13_exact_dedup"])
def test_queries_are_the_plain_ones(spark, name):
    """The registered queries, over all rows, against the plain versions."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.queries()[name](spark, DATA).collect()), key=repr)
    if name == "op12_ranked_search":
        items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
        assert got == plain_search(docs, items)
    elif name == "op13_exact_dedup":
        assert got == plain_groups(docs)
    else:
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want = [(d, *plain_fill(d, t)[:4], sha(plain_fill(d, t)[4]), sha(t or "")) for d, t in docs]
        assert got == sorted(want, key=repr)
