"""BPE encoding and decoding by prefix-sharing trie traversal.

Distinct words of a batch form a trie of symbols, held as the sorted list of
words.  A depth-first walk gives every node the last token of the encoding of
its prefix: of the tokens that end the prefix, the one that may follow the last
token of what precedes it.  A word's encoding is read back along those last
tokens, so that shared prefixes are encoded once.  Two tokens may stand side by
side if merging their joined symbols gives just these two again; such answers
are kept.

The tokenizer's file gives vocabulary, merges and special tokens: lower-casing,
NFC, words cut by the pattern below, byte-level symbols, word-end suffix.

Defined cases: null text counts as empty (no tokens, empty decoding); strings
of special tokens inside a text become their ids; repeated rows are encoded
alike; texts of any length are encoded whole, a very long word taking memory in
proportion to its length; an empty table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

#: Fixed values of the tokenizer's word pattern, with white space spelled out.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: The same for ASCII text.
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
#: Words whose encodings a worker remembers before it starts anew.
CACHE_WORDS = 300_000
#: Answers about two tokens side by side that a worker remembers.
CACHE_PAIRS = 1_000_000


def byte_symbols() -> list[str]:
    """The printable symbol of every byte: itself where Latin-1 prints it, else from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one word-level BPE tokenizer file."""

    def __init__(self, path: str, content: str | None = None):
        if content is None:
            with open(path, encoding="utf-8") as f:
                content = f.read()
        spec = json.loads(content)
        model = spec["model"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.split_special = regex.compile(f"({names})") if names else None
        self.symbols = byte_symbols()
        self.text_of = {i: t for t, i in {**vocab, **self.special}.items()}
        self.n_known = 1 + max(self.text_of, default=0)
        # symbols that the vocabulary lacks get numbers beyond it and are left out of results
        spare = (self.n_known + i for i in range(512))
        lacking = {s: next(spare) for c in self.symbols for s in (c, c + self.suffix) if s not in vocab}
        number = vocab | lacking
        #: rank of a merge by its two tokens; the merge that makes a token, by token
        self.ranks: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank_of: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ", 1)
            made = number[left + right]
            self.ranks.setdefault((number[left], number[right]), rank)
            self.halves.setdefault(made, (number[left], number[right]))
            self.rank_of.setdefault(made, rank)
        self.stable: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        #: usable tokens inside a word and at its end, by their symbols
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        self.size: dict[int, int] = {}
        for token, i in number.items():
            ends = bool(self.suffix) and token.endswith(self.suffix) and token != self.suffix
            stem = token[: -len(self.suffix)] if ends else token
            self.size[i] = len(stem)
            if self.usable(i):
                (self.final if ends else self.inner)[stem] = i
        if not self.suffix:
            self.final = self.inner
        self.longest = max(self.size.values(), default=1)
        self.symbol_table = dict(enumerate(self.symbols))
        #: what the worker remembers of words: ids and decoded text
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, bytes] = {}

    def usable(self, token: int) -> bool:
        """Whether the token's own symbols encode to it alone."""
        known = self.stable.get(token)
        if known is None:
            halves = self.halves.get(token)
            known = halves is None or (
                self.usable(halves[0]) and self.usable(halves[1]) and self.apart(*halves, self.rank_of[token])
            )
            self.stable[token] = known
        return known

    def apart(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge joins ``left`` and ``right`` before time ``limit``.

        Time is the rank of a merge.  The tokens on both sides of the border
        are undone from the last merge back; of equal merges the leftmost comes
        first, so one on the right leaves its own rank to the border.
        """
        ranks, rank_of, halves = self.ranks, self.rank_of, self.halves
        while True:
            rank = ranks.get((left, right))
            if rank is not None and rank < limit:
                return False
            a, b = rank_of.get(left, -1), rank_of.get(right, -1)
            if a > b:
                limit, left = a, halves[left][1]
            elif b < 0:
                return True
            else:
                limit, right = b + 1, halves[right][0]

    def last_token(self, table: dict[str, int], word: str, n: int, last: list[int]) -> int:
        """The last token of the encoding of the first n symbols of a word.

        ``last[i]`` is that of its first i symbols; ``table`` has the tokens
        that may stand here.
        """
        pairs = self.pairs
        for start in range(n - self.longest if n > self.longest else 0, n):
            token = table.get(word[start:n])
            if token is None:
                continue
            if not start:
                return token
            key = last[start] << 20 | token
            good = pairs.get(key)
            if good is None:
                if len(pairs) > CACHE_PAIRS:
                    pairs.clear()
                good = pairs[key] = self.apart(last[start], token, 1 << 40)
            if good:
                return token
        raise ValueError("the vocabulary lacks a symbol")

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Encodings of distinct words, given as byte symbols.

        The sorted words are the trie in depth-first order: what a word shares
        with the one before is the path from the root to where it branches off,
        and the last tokens on that path are kept.
        """
        out: dict[str, list[int]] = {}
        inner, final, size, step = self.inner, self.final, self.size, self.last_token
        last, before = [-1], ""
        for word in sorted(words):
            shared, most = 0, min(len(last) - 1, len(word) - 1)
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            n = len(word)
            for i in range(shared + 1, n):
                last.append(step(inner, word, i, last))
            token = step(final, word, n, last)
            tokens, at = [token], n - size[token]
            while at > 0:
                token = last[at]
                tokens.append(token)
                at -= size[token]
            tokens.reverse()
            out[word] = tokens
            before = word
        return out

    def normal(self, text: str) -> str:
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()

    def words_of(self, text: str) -> list[str]:
        """The words that the tokenizer cuts; a special token gets a leading blank."""
        if self.split_special and "<|" in text:
            pieces = self.split_special.split(text)
            if len(pieces) > 1:
                return [w for p in pieces for w in ([" " + p] if p in self.special else self.plain_words(p))]
        return self.plain_words(text)

    def plain_words(self, text: str) -> list[str]:
        text = self.normal(text)
        return (_ASCII_WORD if text.isascii() else _WORD).findall(text)

    def learn(self, words: set[str]) -> None:
        """Encode new words together and keep the results."""
        as_symbols = {
            w: w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.symbol_table)
            for w in words
        }
        encoded = self.encode_words(set(as_symbols.values()))
        known, text_of, pack = self.n_known, self.text_of, struct.pack
        for word, key in as_symbols.items():
            ids = encoded[key]
            if max(ids) >= known:
                ids = [i for i in ids if i < known]
            self.ids[word] = pack(f"<{len(ids)}I", *ids)
            self.texts[word] = " ".join([text_of[i] for i in ids]).encode()

    def encode_batch(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian 32-bit integers, decoded text in UTF-8) of every text."""
        if len(self.ids) > CACHE_WORDS:
            self.ids.clear()
            self.texts.clear()
        for token, i in self.special.items():
            self.ids[" " + token], self.texts[" " + token] = struct.pack("<I", i), token.encode()
        cut = [self.words_of(text) if text else [] for text in texts]
        new = set().union(*cut).difference(self.ids)
        if new:
            self.learn(new)
        ids, decoded = self.ids, self.texts
        return [
            (b"".join([ids[w] for w in words]), b" ".join([t for t in [decoded[w] for w in words] if t])) for words in cut
        ]

    def decode(self, ids: bytes) -> str:
        """Token strings joined by blanks, as the tokenizer's file has no decoder."""
        return " ".join(self.text_of[i] for (i,) in struct.iter_unpack("<I", ids))


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encode and decode every whole text: one row per document, a map without a shuffle.

    Gives (id, n_tokens, ids_sha256, decoded_sha256), and with ``with_ids`` the
    ids and the decoded text themselves.  Only the driver opens the file; it is
    sent to workers, a few MB.
    """
    with open(path, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(path, content.value)  # a task's own: it takes a fifth of a second, and idle workers hold nothing
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows = bpe.encode_batch(part.column("text").to_pylist())
                columns = [
                    part.column("id"),
                    pa.array([len(i) // 4 for i, _ in rows], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i, _ in rows], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for _, d in rows], pa.string()),
                ]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    ids = [[x for (x,) in struct.iter_unpack("<I", i)] for i, _ in rows]
                    columns += [pa.array(ids, pa.list_(pa.int32())), pa.array([d.decode() for _, d in rows], pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    more = ", ids array<int>, decoded string" if with_ids else ""
    return source.mapInArrow(
        run, f"`{id_col}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}"
    )
