"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Each leaf holds the rank of the pair that starts at a symbol, with the position
in its low bits, so the root's minimum is the leftmost pair of lowest rank.  A
merge changes three leaves, each in logarithmic time; encoding ends when the
root holds no pair.  Normalisation and the cut into pre-tokens are the
tokenizer's own; its model (the merging) is not used.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takepick.llm.common import text_batches
from takepick.llm.tokens import LETTERS, OWNER, ChunkIds, id_type, load, once

NONE = 1 << 62
#: A word of Latin letters and the marks after it: two pre-tokens at most, in composed form as it stands.
PLAIN = re.compile(f"({LETTERS}+)([.,;:!?|]*)")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level pre-tokenisation writes for each byte: itself if printable, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class SegmentTreeBPE:
    """Encoder and decoder of a tokenizers file whose model is BPE."""

    def __init__(self, path: str):
        self.library = load(path)
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[self.vocab[a], self.vocab[b]] = r << 32
            self.made.append(self.vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.size = max(max(self.vocab.values()), *self.special.values(), 0) + 1
        self.token = [""] * self.size
        for table in (self.vocab, self.special):
            for token, i in table.items():
                self.token[i] = token
        self.words: dict[str, list[int]] = {}
        self.letters = byte_letters()
        self.plain = PLAIN if self._as_assumed(spec) else None

    @staticmethod
    def _as_assumed(spec: dict) -> bool:
        """Whether the file's rules are those that ``PLAIN`` and ``lower`` stand for."""
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split, *rest = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        return kinds == ["NFC", "Replace", "Lowercase"] and "[\\p{L}]+" in str(split.get("pattern", {}).get("Regex")) and [r["type"] for r in rest] == ["ByteLevel"]

    def merge(self, symbols: list[int]) -> list[int]:
        """Symbols after all merges, lowest rank first, leftmost first."""
        n, rank, made = len(symbols), self.rank, self.made
        if n < 2:
            return symbols
        width = 1
        while width < n:
            width *= 2
        tree = [NONE] * (2 * width)
        for i in range(n - 1):
            r = rank.get((symbols[i], symbols[i + 1]))
            if r is not None:
                tree[width + i] = r | i
        for i in range(width - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (root := tree[1]) != NONE:
            i = root & 0xFFFFFFFF
            gone = after[i]
            new = symbols[i] = made[root >> 32]
            symbols[gone] = -1
            follows = after[i] = after[gone]
            left = before[i]
            changed = [(gone, NONE)]
            if follows < n:
                before[follows] = i
                r = rank.get((new, symbols[follows]))
                changed.append((i, NONE if r is None else r | i))
            else:
                changed.append((i, NONE))
            if left >= 0:
                r = rank.get((symbols[left], new))
                changed.append((left, NONE if r is None else r | left))
            for at, value in changed:
                at += width
                tree[at] = value
                at >>= 1
                while at:
                    a, b = tree[2 * at], tree[2 * at + 1]
                    low = a if a < b else b
                    if tree[at] == low:
                        break
                    tree[at] = low
                    at >>= 1
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> list[int]:
        """Ids of one pre-token; symbols outside the vocabulary have no id, as in the library."""
        got = self.words.get(word)
        if got is None:
            parts = [*word[:-1], word[-1] + self.suffix]
            got = self.merge([self.vocab[p] for p in parts if p in self.vocab])
            if len(word) <= 64:
                if len(self.words) > 400_000:
                    self.words.clear()
                self.words[word] = got
        return got

    def encode(self, text: str) -> list[int]:
        """Ids of a text; special tokens written in it are those tokens."""
        if self.plain and (m := self.plain.fullmatch(text)):
            word, marks = m.groups()
            word = word.lower()
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(self.letters)
            return self.word(word) + self.word(marks) if marks else self.word(word)
        out: list[int] = []
        for piece in self.special_re.split(text) if self.special_re else [text]:
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                piece = self.library.normalizer.normalize_str(piece) if self.library.normalizer else piece
                for word, _ in self.library.pre_tokenizer.pre_tokenize_str(piece):
                    out += self.word(word)
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, special ones kept: what a tokenizer file without a decoder states."""
        token = self.token
        return " ".join([token[i] for i in ids])


def segment_tree(path: str) -> tuple[SegmentTreeBPE, ChunkIds]:
    def make() -> tuple[SegmentTreeBPE, ChunkIds]:
        bpe = SegmentTreeBPE(path)
        kind = np.dtype(id_type(bpe.size)).char
        return bpe, ChunkIds(lambda new: [array(kind, bpe.encode(c)).tobytes() for c in new], bpe.size, bpe.plain is not None)

    return once(("segment tree", path), make)


def bpe_round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (array of int), decoded (text of those ids).

    Whole texts, without added special tokens, truncation or padding.  A null
    text counts as empty: no ids, empty decoded text.  Null and repeated ids are
    carried as they are; no rows give no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, ids_of = segment_tree(tokenizer)
        for batch in text_batches(batches, "text", 4 << 20, OWNER):
            ids = ids_of(batch.column(1))
            ends = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            decoded = pa.array([bpe.decode(i.tolist()) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, decoded], ["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded string"
    )
