"""Token ids of whole texts, chunk by chunk.

No token of the tokenizers used here spans white space, so the ids of a text are
those of its white-space-separated chunks, one after another.  Texts are cut,
their distinct chunks found and the ids put together in vectors; only words new to
a worker are encoded.  A worker remembers words up to a bound.
"""

from __future__ import annotations

import json
import os
import string
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from takepick.llm.common import claim, kept

MARKS = string.punctuation
#: Latin letters that are letters in composed form and in lower case too, whatever follows.
LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]"


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load(path: str):
    """The library's tokenizer without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # values, and the start and length of each run of them


def gather(runs: Runs, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the runs ``which``, one after another, and the length of each."""
    values, start, length = runs
    lengths = length[which]
    ends = np.cumsum(lengths)
    return values[np.repeat(start[which] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)], lengths


def as_runs(values: np.ndarray, lengths: np.ndarray) -> Runs:
    return values, np.cumsum(lengths) - lengths, lengths


def split_marks(chunks: pa.StringArray) -> tuple[pa.StringArray, pa.StringArray]:
    """Chunks of Latin letters and ASCII marks after them as both parts, A-Z in lower case; any other chunk as it is, and an empty part."""
    core = pc.utf8_rtrim(chunks, MARKS)
    plain = np.asarray(pc.match_substring_regex(core, f"^{LETTERS}+$").to_numpy(zero_copy_only=False), bool)
    words = pc.if_else(pa.array(plain), pc.ascii_lower(core), chunks)
    size, at = (np.asarray(pc.binary_length(x), np.int64) for x in (chunks, core))
    start = np.cumsum(size) - size
    data = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays([0, len(chunks)], chunks), "")[0].as_buffer(), np.uint8)
    marks, lengths = gather((data, start + at, np.where(plain, size - at, 0)), np.arange(len(chunks)))
    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return words, pa.StringArray.from_buffers(len(chunks), pa.py_buffer(ends.tobytes()), pa.py_buffer(marks.tobytes()))


class ChunkIds:
    """Ids of texts.  ``each`` turns words that are new into the bytes of their ids; about ``bound`` words are remembered."""

    def __init__(self, each: Callable[[list[str]], Iterable[bytes]], vocabulary: int, split: bool, bound: int = 300_000):
        self.each, self.split, self.bound, self.seen = each, split, bound, {}
        self.dtype = np.dtype(id_type(vocabulary))

    def _words(self, words: pa.StringArray) -> tuple[Runs, np.ndarray]:
        """Ids of the distinct words, and which of them each word is."""
        coded = words.dictionary_encode()
        distinct, seen = coded.dictionary.to_pylist(), self.seen
        new = [w for w in distinct if w not in seen]
        seen.update(zip(new, self.each(new)))
        found = [seen[w] for w in distinct]
        if len(seen) > self.bound:
            seen.clear()
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        return as_runs(np.frombuffer(b"".join(found), self.dtype), lengths), np.asarray(coded.indices, np.int64)

    def __call__(self, texts: pa.StringArray) -> list[np.ndarray]:
        # only ASCII white space cuts; a chunk with other white space in it is encoded as a text of its own
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        if self.split:
            runs = None
            for part in split_marks(coded.dictionary):
                ids, lengths = gather(*self._words(part))
                more = as_runs(ids, lengths)
                runs = more if runs is None else _joined(runs, more)
        else:
            words, which = self._words(coded.dictionary)
            runs = as_runs(*gather(words, which))
        ids, lengths = gather(runs, np.asarray(coded.indices, np.int64))
        ends = np.concatenate(([0], np.cumsum(lengths)))
        cuts = np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(lists), np.int64))))
        return np.split(ids, ends[cuts[1:-1]]) if len(texts) else []


def _joined(a: Runs, b: Runs) -> Runs:
    """Each run of ``a`` with that of ``b`` after it."""
    n = len(a[1])
    both = (np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1] + len(a[0]))), np.concatenate((a[2], b[2])))
    return as_runs(gather(both, np.arange(2 * n).reshape(2, n).T.ravel())[0], a[2] + b[2])


OWNER = "tokens"


def once(key: tuple, make: Callable):
    """One object for each key in a worker process, so that tasks share what was seen."""
    claim(OWNER)
    if key not in kept:
        kept[key] = make()
    return kept[key]


def cuts_at_marks(spec: dict) -> bool:
    """Whether the rules of a tokenizer file ignore case and end a pre-token between letters and the marks after them."""
    kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    words = str(((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex"))
    return "Lowercase" in kinds and r"[\p{L}]+" in words and r"[^\s\p{L}\p{N}]+" in words


class LibraryWords:
    """New words by the tokenizers library.

    Words of letters are pre-tokens, and where the file ends each pre-token with a
    token of its own kind, many are encoded in one text that is cut again after
    those tokens.  If there are not as many as words, and for all other words, each
    is encoded by itself.
    """

    def __init__(self, path: str):
        self.library = load(path)
        self.dtype = np.dtype(id_type(self.library.get_vocab_size()))
        spec = json.load(open(path, encoding="utf-8"))
        self.split, suffix = cuts_at_marks(spec), spec["model"].get("end_of_word_suffix")
        self.ends = None
        if suffix and self.split:
            self.ends = np.zeros(self.library.get_vocab_size(), bool)
            self.ends[[i for t, i in self.library.get_vocab().items() if t.endswith(suffix)]] = True

    def _each(self, words: list[str]) -> list[bytes]:
        return [array(self.dtype.char, e.ids).tobytes() for e in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _many(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        parts = [words[at : at + 2000] for at in range(0, len(words), 2000)]
        for part, e in zip(parts, self.library.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(e.ids, self.dtype)
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize
            if len(cuts) != len(part):
                out += self._each(part)
                continue
            raw, cuts = ids.tobytes(), cuts.tolist()
            out += [raw[a:b] for a, b in zip([0, *cuts], cuts)]
        return out

    def __call__(self, new: list[str]) -> Iterable[bytes]:
        letters = [self.ends is not None and w.isalpha() for w in new]
        many = iter(self._many([w for w, x in zip(new, letters) if x]))
        each = iter(self._each([w for w, x in zip(new, letters) if not x]))
        return [next(many) if x else next(each) for x in letters]


def library_ids(path: str) -> ChunkIds:
    """Ids by the tokenizers library."""

    def make() -> ChunkIds:
        words = LibraryWords(path)
        return ChunkIds(words, words.library.get_vocab_size(), words.split)

    return once(("library", path), make)
