"""Language ID by prediction by partial matching.

Each language has a byte context tree of variable order up to ``ORDER``,
learned from a bounded sample of labelled texts.  Under the frozen counts a
byte costs -log2 of its probability in the longest known context; unseen bytes
pay the escape probability and fall to the next shorter context, at the end to
one of 256 equal bytes.  A text gets the language of the shortest code.

The trees of all languages are compiled into one sparse table: for every pair
of context and byte that any language has seen, its exact code length in every
language, and for every context its escape in every language.  A byte is looked
up once for all languages.

Bounds, all of the training sample: ``MAX_TEXTS`` texts and ``MAX_BYTES`` bytes
a language, and one piece of ``PIECE`` characters of a longer text.  Languages
and contexts are not capped, so the driver holds MAX_BYTES for each language,
and the table at most (ORDER + 1) * MAX_BYTES pairs for each.

``calibrated`` also learns, for each language and class of length, the most
bits a letter that text in that language takes, so that text in none of the
learned languages can be told.  Each segment of a text counts in the language
that suits it best, so text in several known languages is known too.

Defined cases: null text, or text without a letter, is ``und`` with score 0;
ties go to the language first in alphabetical order; repeated rows are scored
alike; very long texts are scored whole, in pieces of ``CHUNK`` bytes; with no
labelled text at all every text is ``und``; an empty table gives an empty
result.  Only the named columns are read; a result column whose name a kept
column bears gets a trailing underscore.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_names, lean

ORDER = 3
#: Bounds of the training sample: texts and bytes per language, characters of one text.
MAX_TEXTS = 400
MAX_BYTES = 250_000
PIECE = 30_000
#: Bytes of text scored at once, divided among the languages.
CHUNK = 1 << 20
#: Texts scored at once.
ROWS = 512
#: Bytes of a segment; the segments of a text may be in different languages.
SEGMENT = 128
#: Lower bounds of the classes of length in letters; shorter texts are never told foreign.
CLASSES = (16, 64, 256, 1024)
#: Robust standard deviations beyond the median from which a text is in no learned language.
FOREIGN = 8.0
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_IS_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_IS_LETTER = np.array([b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])


class Lookup:
    """Numbers of known keys, by open addressing; -1 for others."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.keys = keys
        left, place = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.slots[place] < 0
            self.slots[place[free]] = left[free]  # of several, the last stays
            lost = self.slots[place] != left
            left, place = left[lost], (place[lost] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        out = np.full(len(wanted), -1, np.int64)
        if not len(self.keys):
            return out
        at, place = None, self._home(wanted)
        while len(place):
            found = self.slots[place]
            hit = (found >= 0) & (self.keys[found] == wanted)
            if at is None:
                out[hit] = found[hit]
            else:
                out[at[hit]] = found[hit]
            on = ~hit & (found >= 0)
            at = np.flatnonzero(on) if at is None else at[on]
            wanted, place = wanted[on], (place[on] + 1) & ((1 << self.bits) - 1)
        return out


@dataclass
class Trees:
    """Compiled context trees of all languages."""

    languages: list[str]
    symbol: np.ndarray  # byte -> symbol, 0 for bytes that no training text has
    n_symbols: int
    pairs: list[Lookup] = field(default_factory=list)  # by order: context and symbol
    lengths: list[np.ndarray] = field(default_factory=list)  # by order: pairs x languages, bits
    contexts: list[Lookup] = field(default_factory=list)
    escapes: list[np.ndarray] = field(default_factory=list)  # by order: contexts x languages, bits
    limits: np.ndarray | None = None  # languages x classes of length, bits a letter


def pair_keys(texts: list[bytes], symbol: np.ndarray, n: int) -> list[np.ndarray]:
    """By order, the key of every place: the symbols of its context, then its own."""
    out = []
    padded = [np.concatenate([np.zeros(ORDER, np.int64), symbol[np.frombuffer(raw, np.uint8)]]) for raw in texts]
    for k in range(ORDER + 1):
        parts = [np.zeros(0, np.int64)]
        for s in padded:
            key = np.zeros(len(s) - ORDER, np.int64)
            for j in range(ORDER - k, ORDER + 1):
                key = key * n + s[j : len(s) - ORDER + j]
            parts.append(key)
        out.append(np.concatenate(parts))
    return out


def compile_trees(samples: dict[str, list[bytes]]) -> Trees:
    languages = sorted(samples)
    present = np.zeros(256, bool)
    for texts in samples.values():
        for raw in texts:
            present[np.frombuffer(raw, np.uint8)] = True
    symbol = np.zeros(256, np.int64)
    symbol[present] = np.arange(1, present.sum() + 1)
    n = int(present.sum()) + 1
    trees = Trees(languages, symbol, n)
    counted = [[np.unique(keys, return_counts=True) for keys in pair_keys(samples[name], symbol, n)] for name in languages]
    for k in range(ORDER + 1):
        keys = np.unique(np.concatenate([np.zeros(0, np.int64), *(c[k][0] for c in counted)]))
        contexts, row = np.unique(keys // n, return_inverse=True)
        # the same symbol after the context without its oldest symbol
        shorter = np.searchsorted(trees.pairs[-1].keys, keys % n**k) if k else None
        lengths = np.zeros((len(keys), len(languages)), np.float32)
        escapes = np.zeros((len(contexts), len(languages)), np.float32)
        for i, counts in enumerate(counted):
            seen = np.zeros(len(keys), np.int64)
            seen[np.searchsorted(keys, counts[k][0])] = counts[k][1]
            total = np.bincount(row, seen, len(contexts))
            distinct = np.bincount(row, seen > 0, len(contexts))
            known = total > 0
            escapes[known, i] = -np.log2(distinct[known] / (total + distinct)[known])
            below = trees.lengths[-1][shorter, i] if k else 8.0
            own = np.maximum(seen, 1) / np.maximum((total + distinct)[row], 1)
            lengths[:, i] = np.where(seen > 0, -np.log2(own), escapes[row, i] + below)
        trees.pairs.append(Lookup(keys))
        trees.lengths.append(lengths)
        trees.contexts.append(Lookup(contexts))
        trees.escapes.append(escapes)
    return trees


def symbol_bits(history: list[np.ndarray], s: np.ndarray, trees: Trees) -> np.ndarray:
    """Code lengths (places x languages) of symbols after their histories, nearest first."""
    n = trees.n_symbols
    out = np.zeros((len(s), len(trees.languages)), np.float32)
    at: np.ndarray | slice = slice(None)
    for k in range(ORDER, -1, -1):
        context = np.zeros(len(s), np.int64)
        for j in range(k - 1, -1, -1):
            context = context * n + history[j]
        pair = trees.pairs[k](context * n + s)
        hit = pair >= 0
        if k == ORDER and hit.all():
            return trees.lengths[k][pair]
        rows = np.flatnonzero(hit) if isinstance(at, slice) else at[hit]
        out[rows] += trees.lengths[k][pair[hit]]
        miss = ~hit
        at = np.flatnonzero(miss) if isinstance(at, slice) else at[miss]
        s, history, context = s[miss], [h[miss] for h in history], context[miss]
        if not len(s):
            return out
        number = trees.contexts[k](context)
        known = number >= 0
        out[at[known]] += trees.escapes[k][number[known]]
    out[at] += 8.0
    return out


def letters_of_words(data: np.ndarray) -> np.ndarray:
    """Which bytes are letters, of ASCII or in other characters, with no digit next to them."""
    digit = _IS_DIGIT[data]
    out = _IS_LETTER[data]
    out[1:] &= ~digit[:-1]
    out[:-1] &= ~digit[1:]
    return out


@dataclass
class Scores:
    """Code lengths of texts, and of their letters by segment."""

    whole: np.ndarray  # texts x languages, bits
    owner: np.ndarray  # segment -> text
    letters: np.ndarray  # segments x languages, bits of letters
    counts: np.ndarray  # letters of each segment


def score_texts(texts: list[bytes], trees: Trees, letters: bool = True) -> Scores:
    """Scores of whole texts, zero for empty ones, of letters only if asked for.

    Data larger than a chunk go in pieces.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    n_segments = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), n_segments)
    starts = np.cumsum(sizes) - sizes
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(n_segments) - n_segments, n_segments)
    segments = starts[owner] + SEGMENT * inside
    width = len(trees.languages)
    bits_of, letters_of, counts = np.zeros((len(owner), width)), np.zeros((len(owner), width)), np.zeros(len(owner), np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    full = np.flatnonzero(sizes)
    starts, ends = starts[full], (starts + sizes)[full]
    seg_ends = np.append(segments[1:], len(data))
    step = max(ORDER + 1, CHUNK // max(1, width))
    for lo in range(0, len(data) if width else 0, step):
        hi = min(len(data), lo + step)
        s = trees.symbol[data[max(0, lo - ORDER) : hi]]
        s = np.concatenate([np.zeros(ORDER - min(ORDER, lo), np.int64), s])
        first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, hi, "left")
        history = [s[ORDER - k : len(s) - k].copy() for k in range(1, ORDER + 1)]
        for k in range(1, ORDER + 1):  # no context reaches back over the start of a text
            for offset in range(k):
                at = starts[first:last] + offset
                at = at[(at >= lo) & (at < hi) & (at < ends[first:last])] - lo
                history[k - 1][at] = 0
        bits = symbol_bits(history, s[ORDER:], trees)
        first, last = np.searchsorted(seg_ends, lo, "right"), np.searchsorted(segments, hi, "left")
        cuts = np.maximum(segments[first:last] - lo, 0)
        bits_of[first:last] += np.add.reduceat(bits, cuts, axis=0, dtype=np.float64)
        if not letters:
            continue
        letter = letters_of_words(data[max(0, lo - 1) : hi + 1])[lo > 0 : (lo > 0) + hi - lo]
        bits[~letter] = 0
        letters_of[first:last] += np.add.reduceat(bits, cuts, axis=0, dtype=np.float64)
        counts[first:last] += np.add.reduceat(letter, cuts, dtype=np.int64)
    whole = np.zeros((len(texts), width))
    np.add.at(whole, owner, bits_of)
    return Scores(whole, owner, letters_of, counts)


def known_texts(scores: Scores, n_texts: int, limits: np.ndarray | None) -> np.ndarray:
    """Whether each text's letters cost no more than the limits of its segments' languages."""
    total = np.bincount(scores.owner, scores.counts, n_texts).astype(np.int64)
    c = length_class(total)
    if limits is None or not limits.size:
        return np.ones(n_texts, bool)
    best = scores.letters.argmin(axis=1) if len(scores.owner) else np.zeros(0, np.int64)
    bits = np.bincount(scores.owner, scores.letters[np.arange(len(best)), best], n_texts)
    rate = limits[best, np.maximum(c[scores.owner], 0)]
    allowed = np.bincount(scores.owner, np.where(scores.counts > 0, rate * np.maximum(scores.counts, 1), 0), n_texts)
    return (c < 0) | (bits <= allowed)


_ASCII_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))


def has_letter(raw: bytes | None) -> bool:
    if not raw:
        return False
    head = raw[:256]
    if len(head.translate(None, _ASCII_LETTERS)) < len(head) or len(raw.translate(None, _ASCII_LETTERS)) < len(raw):
        return True
    return any(c.isalpha() for c in raw.decode("utf-8", "ignore"))


def length_class(n_letters: np.ndarray) -> np.ndarray:
    """Class of length, -1 below the first."""
    return np.searchsorted(CLASSES, n_letters, "right") - 1


def calibrated(samples: dict[str, list[bytes]]) -> Trees:
    """Trees of all samples, with limits from texts that trees of the others score.

    Every fifth text is held out, and cut into pieces as short as each class of
    length allows.  A limit is the median of the pieces' bits a letter and
    FOREIGN robust deviations more, so junk among the texts doesn't move it.  A
    class without ten pieces takes the limit of the class below, or none.
    """
    trees = compile_trees(samples)
    fitted = compile_trees({k: [t for i, t in enumerate(v) if i % 5 != 4] for k, v in samples.items()})
    trees.limits = np.full((len(trees.languages), len(CLASSES)), np.inf)
    for i, name in enumerate(trees.languages):
        held = samples[name][4::5]
        for c, size in enumerate(CLASSES):
            step = size * 5 // 4  # some of a piece is no letters
            pieces = [t[a : a + step] for t in held for a in range(0, len(t) - step + 1, step)]
            scored = score_texts(pieces, fitted)
            counts = np.bincount(scored.owner, scored.counts, len(pieces))
            bits = np.bincount(scored.owner, scored.letters[:, i], len(pieces))
            rates = bits[counts >= size // 2] / counts[counts >= size // 2]
            if len(rates) >= 10:
                middle = np.median(rates)
                trees.limits[i, c] = middle + FOREIGN * 1.4826 * max(np.median(np.abs(rates - middle)), 0.02)
            elif c:
                trees.limits[i, c] = trees.limits[i, c - 1]
    return trees


def sample_texts(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id") -> dict[str, list[bytes]]:
    """A bounded, deterministic sample of labelled texts by language.

    Languages are counted over all rows; of each, rows whose hash is lowest are
    taken, at most MAX_TEXTS texts and MAX_BYTES bytes.  Of a text longer than
    PIECE characters one piece is taken, from a place given by the hash.  All
    bounds hold before rows reach the driver.
    """
    rows = labelled.select(
        F.col(text_col).alias("text"),
        F.col(lang_col).alias("lang"),
        F.xxhash64(F.col(key_col), F.col(text_col)).alias("u"),
    ).where("lang is not null and text is not null and text <> ''")
    # a table of languages, as many rows as there are labels
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(2.0 * MAX_TEXTS) / F.col("n")) * 1_000_000 + 1
    drawn = rows.join(F.broadcast(sizes), "lang").where(F.pmod("u", F.lit(1_000_000)) < share)
    start = F.when(F.length("text") > PIECE, F.pmod(F.col("u"), F.length("text") - (PIECE - 1)) + 1).otherwise(1)
    drawn = drawn.select("lang", "u", F.substring("text", start.cast("int"), F.lit(PIECE)).alias("text"))
    turn = Window.partitionBy("lang").orderBy("u", "text")
    first = drawn.withColumn("k", F.row_number().over(turn)).where(F.col("k") <= MAX_TEXTS)
    room = F.sum(F.octet_length("text")).over(turn.rowsBetween(Window.unboundedPreceding, -1))
    bounded = first.withColumn("before", F.coalesce(room, F.lit(0))).where(F.col("before") < MAX_BYTES)
    samples: dict[str, list[bytes]] = {}
    for r in sorted(bounded.select("lang", "k", "text").collect(), key=lambda r: (r["lang"], r["k"])):
        samples.setdefault(r["lang"], []).append(r["text"].encode())
    return samples


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", limits: bool = False) -> Trees:
    """Learn trees from a bounded sample of labelled texts; with ``limits``, calibrated."""
    return (calibrated if limits else compile_trees)(sample_texts(labelled, text_col, lang_col, key_col))


RESULTS = ["lang_pred", "score", "bits_per_byte", "known"]


def predict(
    docs: DataFrame,
    trees: Trees | Broadcast,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: dict[str, Column] | None = None,
    keep_text: bool = False,
) -> DataFrame:
    """Score every whole text: (id, text if kept, kept columns, lang_pred, score, bits_per_byte, known).

    A map over the scan, without a shuffle.  ``score`` is the softmax of the
    code lengths a byte, sharpened by a fixed factor.  ``known`` says whether
    the text's letters cost no more than the limits for texts of its length, of
    the language of each segment; without limits it is true of all but ``und``.
    """
    keep = keep or {}
    model = trees if isinstance(trees, Broadcast) else docs.sparkSession.sparkContext.broadcast(trees)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(c.alias(f"k_{n}") for n, c in keep.items()))
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    first = [id_col, *([text_col] if keep_text else []), *keep]
    names_out = [*first, *free_names(first, RESULTS)]
    types = [kinds["id"], *(["string"] if keep_text else []), *(kinds[f"k_{n}"] for n in keep), "string", "double", "double", "boolean"]
    passed = ["id", *(["text"] if keep_text else []), *(f"k_{n}" for n in keep)]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = model.value
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                yield one(whole.slice(lo, ROWS), frozen)

    def one(batch: pa.RecordBatch, frozen: Trees) -> pa.RecordBatch:
        texts = raw_texts_of(batch)
        found = score_texts([t or b"" for t in texts], frozen, letters=frozen.limits is not None)
        fits = known_texts(found, len(texts), frozen.limits)
        names, scores, rates, known = [], [], [], []
        for raw, row, fit_ in zip(texts, found.whole, fits.tolist(), strict=True):
            if not len(row) or not has_letter(raw):
                names.append("und")
                scores.append(0.0)
                rates.append(None)
                known.append(False)
                continue
            best = int(row.argmin())
            odds = np.exp2(np.maximum((row[best] - row) / len(raw) * 16, -64))
            names.append(frozen.languages[best])
            scores.append(float(1 / odds.sum()))
            rates.append(float(row[best] / len(raw)))
            known.append(fit_)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in passed), pa.array(names, pa.string()),
             pa.array(scores, pa.float64()), pa.array(rates, pa.float64()), pa.array(known, pa.bool_())],
            names=names_out,
        )

    return source.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in zip(names_out, types, strict=True)))


def raw_texts_of(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()
