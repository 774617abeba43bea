"""BPE encoding and decoding with a published vocabulary.

A word's symbols form a doubly linked list; all neighbour pairs with a merge rank wait in a
priority queue. The best pair is merged in place, its two new neighbour pairs are queued, and
entries whose symbols have changed meanwhile are skipped when they come up. That is
O(n log n) for a word of n symbols, however long it is.

Text runs through slices of Arrow batches on the executors, map-only; a slice has a bounded number of bytes. Most words repeat, also from
task to task, so a worker process keeps a two-generation cache of the ids of words, bounded in entries and in bytes; it is part of the broadcast
vocabulary and goes with it. The vocabulary (a fixed file, read on the driver from the ``path`` given) has a size that doesn't depend on the data.
Decoding takes the strings of a text's ids from an Arrow array and joins them.

Defined results: a NULL or empty text has no tokens and decodes to an empty string; strings of
special tokens in a text become those tokens; bytes and characters without a symbol in the
vocabulary are left out, as its file defines no unknown token; characters younger than the Unicode
tables of the interpreter may be cut and lower-cased in another way than the library does; rows are handled one by one, so
repeated rows, an empty table and further columns need no rule.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from sparkgrad.llm.byte_bpe import byte_characters
from sparkgrad.llm.slices import map_texts
from sparkgrad.llm.text import read

VOCABULARY = "word_bpe_49k.json"
CACHE_ENTRIES = 300_000  # twice as many at most are held
CACHE_BYTES = 16 << 20  # of words and ids in a generation
MAX_CACHED = 64
SHORT, FAR = 14, 32  # bits of a place in a queue entry: entries of pieces up to 2**14 symbols fit into one digit of Python's integers
# with this pattern such marks behind a run of letters are one piece
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
# str.split() also splits at these four, which the vocabulary's pattern counts as symbols
SEPARATORS = regex.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"[^\S\x1c-\x1f]+")


class Words(dict):
    """Packed ids of each word or piece; a full generation becomes the old one."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.old, self.held = make, {}, 0

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.make(word)
        if len(word) <= MAX_CACHED:
            if len(self) >= CACHE_ENTRIES or self.held >= CACHE_BYTES:
                self.old, self.held = self.copy(), 0
                self.clear()
            self[word] = found
            self.held += len(word) + len(found)
        return found


class Codec:
    """Encoder and decoder of one vocabulary file (model BPE with a word-end suffix)."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError("a BPE vocabulary with a word-end suffix is needed")
        self.suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts = {i: s for s, i in [*vocab.items(), *self.special.items()]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merged = [vocab[a + b] for a, b in pairs]  # by rank
        self.ranks: dict[int, dict[int, int]] = {i: {} for i in vocab.values()}  # of a left symbol, by its right one
        for rank, (a, b) in enumerate(pairs):
            self.ranks[vocab[a]][vocab[b]] = rank << SHORT
        self.strings = pa.array([self.texts.get(i, "").encode("utf-8", "surrogatepass") for i in range(max(self.texts) + 1)], pa.large_binary())
        self.packed = {i: struct.pack("<I", i) for i in self.texts}
        self.inner = [vocab.get(c) for c in byte_characters()]
        self.final = [vocab.get(c + self.suffix) for c in byte_characters()]
        self.gaps = None in self.inner or None in self.final
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.ends = ENDS if split["pattern"]["Regex"] == PATTERN else ""
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.far = None
        self.forget()

    def __getstate__(self):
        return {name: value for name, value in self.__dict__.items() if name != "words"}

    def __setstate__(self, state: dict):
        self.__dict__ = state
        self.forget()

    def forget(self) -> None:
        """Empties the cache."""
        self.words = Words(self.word)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece. Queue entries are rank and place in one number, so the smallest is the next merge."""
        symbols = [self.inner[b] for b in piece]
        symbols[-1] = self.final[piece[-1]]
        if self.gaps:
            symbols = [s for s in symbols if s is not None]
        n, merged = len(symbols), self.merged
        ranks, place = (self.ranks, SHORT) if n <= 1 << SHORT else (self.far_ranks(), FAR)
        places, never = (1 << place) - 1, len(merged) << place
        valid = [ranks[a].get(b, never) + i for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]  # the entry of the pair that starts here
        queue = [entry for entry in valid if entry < never]
        heapify(queue)
        valid.append(never)
        after, before = [*range(1, n + 1)], [*range(-1, n)]
        while queue:
            entry = heappop(queue)
            i = entry & places
            if valid[i] != entry:
                continue  # one of the two has been merged since
            j = after[i]
            symbols[i] = new = merged[entry >> place]
            symbols[j], valid[j], after[i] = -1, never, (k := after[j])
            before[k] = i
            if i and (h := before[i]) >= 0:
                valid[h] = entry = ranks[symbols[h]].get(new, never) + h
                if entry < never:
                    heappush(queue, entry)
            if k < n:
                valid[i] = entry = ranks[new].get(symbols[k], never) + i
                if entry < never:
                    heappush(queue, entry)
            else:
                valid[i] = never
        return [s for s in symbols if s >= 0]

    def far_ranks(self) -> dict[int, dict[int, int]]:
        if self.far is None:
            self.far = {a: {b: rank << FAR - SHORT for b, rank in found.items()} for a, found in self.ranks.items()}
        return self.far

    def word(self, word: str) -> bytes:
        """Packed ids of a run of characters without white space. A piece is a word whose only piece it is."""
        if not word.isalpha():
            head = word.rstrip(self.ends)
            pieces = [head, word[len(head):]] if head.isalpha() and head != word else self.pieces.findall(word)
            if pieces != [word]:
                return b"".join([self.words[p] for p in pieces])
        packed = self.packed
        return b"".join([packed[i] for i in self.merge(word.encode("utf-8", "surrogatepass"))])

    def plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final form: lower case goes by single characters
        text = text.lower()
        words = filter(None, SPACE.split(text)) if SEPARATORS.search(text) else text.split()
        return b"".join(map(self.words.__getitem__, words))

    def ids(self, text: str) -> bytes:
        if self.marks and any(s in text for s in self.special):
            return b"".join([self.packed[self.special[part]] if k % 2 else self.plain(part) for k, part in enumerate(self.marks.split(text))])
        return self.plain(text)

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the text they decode to."""
        ids = self.ids(text) if text else b""
        return ids, self.decode_packed([ids])[0].decode("utf-8", "surrogatepass")

    def decode_packed(self, ids: list[bytes]) -> list[bytes]:
        """``decode`` of the ids of each text as ``encode`` packs them, in UTF-8."""
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int64) // 4
        strings = self.strings.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), strings), pa.scalar(b" ", strings.type)).to_pylist()

    def decode(self, ids: list[int]) -> str:
        """The vocabulary's strings one after the other, a space between them: its file names no decoder."""
        return " ".join([self.texts[i] for i in ids if i in self.texts])


def load(path: str) -> Codec:
    with open(path, encoding="utf-8") as file:
        return Codec(json.load(file))


def _mapped(docs: DataFrame, path: str, text: str, keep: tuple[str, ...], added: str,
            columns: Callable[[Codec, list[str | None]], Sequence[list]]) -> DataFrame:
    codec = docs.sparkSession.sparkContext.broadcast(load(path))
    return map_texts(docs, text, keep, added, lambda: partial(columns, codec.value))


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The columns in ``keep``, packed ids (binary) and decoded text. ``path``: vocabulary file on the driver."""
    def columns(codec: Codec, texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        done = [codec.encode(t) for t in texts]
        return [d[0] for d in done], [d[1] for d in done]

    return _mapped(docs, path, text, keep, f"`{ids}` binary, `{decoded}` string", columns)


def digests(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep``, the number of ids, and digests of packed ids and decoded text; these themselves stay in the worker."""
    digest = lambda value: hashlib.sha256(value).hexdigest()

    def columns(codec: Codec, texts: list[str | None]) -> tuple[list[int], list[str], list[str]]:
        done = [codec.ids(t) if t else b"" for t in texts]
        return [len(d) // 4 for d in done], [digest(d) for d in done], [digest(d) for d in codec.decode_packed(done)]

    return _mapped(docs, path, text, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string", columns)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"), vocabulary_path())
