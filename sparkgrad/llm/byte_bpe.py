"""Byte-level BPE ids by the tokenizers library, with a bounded cache of encoded words.

The vocabulary's pattern decides where pieces end, and no merge crosses a piece. ``CHUNK`` cuts a text only at such ends: before a
space that something else than white space follows, and around the other runs of white space as the pattern has them. A text in
which every space stands before something else than white space is cut at its spaces alone, and each different part of the texts given
at once is looked up once. Each different chunk is encoded once while it is in the worker's cache: a plain word or number and the marks behind it go straight to the library's BPE
model, all other chunks through the whole library. Texts with a special token's string, and files with another
pre-tokenizer or a normalizer, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.json"
CACHE_ENTRIES = 200_000  # twice as many at most are held, about 170 bytes each, of the chunks behind a space and of the others
MAX_CACHED = 64

# \s of Python has four characters more than the vocabulary's pattern
CHUNK = re.compile(r"[^\S\x1c-\x1f]+(?![\S\x1c-\x1f])| ?[\S\x1c-\x1f]+|[^\S\x1c-\x1f]")
# a word or number and the marks behind it: two pieces in any version of the character tables
WORD = re.compile(r"( ?(?:[A-Za-zÀ-ÖØ-öø-ɏ]+|[0-9]+))?((?(1)| ?)[!-&(-/:-@\[-`{-~]+)?")
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")  # those of WORD
WHITE = re.compile(r"[^\S\x1c-\x1f]")
SPACE = "Ġ"  # the printable character that stands for the space


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def file_text(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def may_cut(spec: dict) -> bool:
    before, model = spec["pre_tokenizer"] or {}, spec["model"]
    return (before.get("type") == "ByteLevel" and before.get("use_regex") is True and not before.get("add_prefix_space")
            and not spec["normalizer"] and not spec["truncation"] and not spec["padding"]
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))


class Words(dict):
    """Packed ids of each chunk; a full generation becomes the old one. ``encode`` says whether its result is worth a place."""

    def __init__(self, encode, entries: int):
        super().__init__()
        self.encode, self.entries, self.old = encode, entries, {}

    def __missing__(self, chunk: str) -> bytes | None:
        found = self.old.get(chunk)
        if found is None:
            found, keep = self.encode(chunk)
            if not keep or len(chunk) > MAX_CACHED:
                return found
        if len(self) >= self.entries:
            self.old = self.copy()
            self.clear()
        self[chunk] = found
        return found


class Encoder:
    """``spec``: content of a vocabulary file. ``plain``: strings of special tokens are ordinary text. ``entries``: in place of CACHE_ENTRIES."""

    def __init__(self, spec: str, plain: bool = False, entries: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = plain
        known = json.loads(spec)
        self.kind = np.dtype("<u2" if max(self.library.get_vocab(with_added_tokens=True).values(), default=0) < 1 << 16 else "<u4")
        self.cuts = may_cut(known)
        if self.cuts:
            self.special = [] if plain else [t["content"] for t in known["added_tokens"]]
            merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in known["model"]["merges"]]
            self.model = BPE(known["model"]["vocab"], merges, cache_capacity=0)
            self.shown = dict(enumerate(byte_characters()))
            self.packed = [i.to_bytes(self.kind.itemsize, "little") for i in range(max(known["model"]["vocab"].values()) + 1)]
            entries = entries or CACHE_ENTRIES
            self.words, self.others = Words(self.behind_space, entries), Words(self.chunk, entries)

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind).tobytes()

    def plain(self, shown: str) -> bytes:
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(shown)])

    def chunk(self, chunk: str) -> tuple[bytes, bool]:
        found = WORD.fullmatch(chunk)
        if not found:
            return self.whole(chunk), True
        word, marks = found.groups()
        if word and marks:
            return self.known(word) + self.others[marks], False
        return self.plain(chunk.replace(" ", SPACE) if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.shown)), True

    def behind_space(self, rest: str) -> tuple[bytes | None, bool]:
        """Ids of a space and ``rest``, which has none; None if the space may belong to a run of white space."""
        if rest.isascii():
            if rest.isalpha():
                return self.plain(SPACE + rest), True
            word = rest.rstrip(MARKS)
            if word.isalpha():
                return self.words[word] + self.others[rest[len(word):]], False
        if not rest or WHITE.match(rest):
            return None, False
        return (self.by_pattern(" " + rest), False) if WHITE.search(rest) else self.chunk(" " + rest)

    def known(self, chunk: str) -> bytes:
        return self.words[chunk[1:]] if chunk[0] == " " and chunk.strip() else self.others[chunk]

    def by_pattern(self, text: str) -> bytes:
        return b"".join(map(self.known, CHUNK.findall(text)))

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text, packed as ``kind``."""
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not self.cuts:
            return [self.whole(t) for t in column.to_pylist()]
        if not len(column):
            return []
        parts = pc.split_pattern(column, " ")
        ends = parts.offsets.to_numpy()[1:]
        first = parts.offsets.to_numpy()[:-1]
        found = parts.flatten().dictionary_encode()
        codes, different = found.indices.to_numpy(), found.dictionary.to_numpy(zero_copy_only=False)
        used = np.zeros(len(different), bool)
        used[np.delete(codes, first)] = True
        get = self.words.__getitem__
        known = [get(part) if behind else b"" for part, behind in zip(different.tolist(), used.tolist())]
        unfit = np.array([k is None for k in known])[codes]
        unfit[first] = False
        by_pattern = np.logical_or.reduceat(unfit, first)
        heads = map(self.by_pattern, different[codes[first]].tolist())
        out = [head + tail for head, tail in zip(heads, self.joined([k or b"" for k in known], codes, first, ends))]
        whole = np.zeros(len(column), bool)
        for string in self.special:
            whole |= pc.match_substring(column, string).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(whole | by_pattern).tolist():
            text = column[i].as_py()
            out[i] = self.whole(text) if whole[i] else self.by_pattern(text)
        return out

    def joined(self, known: list[bytes], codes: np.ndarray, first: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """known[codes[i]] for i from behind first[k] to ends[k], as one string for each k."""
        width = self.kind.itemsize
        sizes = np.array([len(k) for k in known]) // width
        starts = np.cumsum(sizes) - sizes
        n = sizes[codes]
        n[first] = 0
        upto = np.cumsum(n)
        places = np.repeat(starts[codes] - (upto - n), n) + np.arange(upto[-1])
        ids = np.frombuffer(b"".join(known), self.kind)[places].tobytes()
        cut = (upto[ends - 1] * width).tolist()
        return [ids[a:b] for a, b in zip([0, *cut], cut)]


@lru_cache(maxsize=2)
def encoder(spec: str, plain: bool = False, entries: int | None = None) -> Encoder:
    """One encoder per worker process: loading it takes longer than most slices, and its cache has a fixed size."""
    return Encoder(spec, plain, entries)
