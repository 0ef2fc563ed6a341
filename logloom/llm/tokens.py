"""Token ids of whole texts, equal to the tokenizers library's.

``byte_level_encoder`` reads a byte-level BPE file of that library and merges
with the BPE core of tiktoken over the file's own vocabulary, in the file's own
order, which takes a third of the time. ``Encoder`` encodes with the library
itself: a BPE model never merges across the borders of its pre-tokenizer, so
texts are cut at such borders, the ids of recurring words are kept per worker
and only new pieces go through the library's model.

Both give ``Tokenizer.encode(text, add_special_tokens=False).ids`` as the library
is set by default: an added token of the file that a text spells out
(``<|endoftext|>``) is one id. Texts that hold one, and all texts under files of
another shape, are encoded by the library text by text.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

#: Fixed value: the pattern that byte-level pre-tokenizers use unless they bring their own.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same without its look-ahead, which only matters where two white-space characters meet.
SINGLE_SPACES_PATTERN = BYTE_LEVEL_PATTERN.replace(r"\s+(?!\S)|", "")
PAIRS = ("  ", "\n\n", " \n", "\n ")
#: White space other than the space and the line feed.
RARE_ASCII = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
RARE = RARE_ASCII + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

WORDS_KEPT, PIECES_KEPT = 300_000, 600_000
_LOADED: dict[tuple, object] = {}


def encoder(path: str):
    """``encode(texts) -> ids`` as little-endian unsigned 32-bit bytes; loaded once per worker and file."""
    return _loaded(Encoder, path).encode


def byte_level_encoder(path: str):
    return _loaded(_fast, path)


def _loaded(make, path: str):
    if (make, path) not in _LOADED:
        _LOADED[make, path] = make(path)
    return _LOADED[make, path]


def _file(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    spec = json.loads(tokenizer.to_str())
    plain = spec["model"]["type"] == "BPE" and not spec["model"].get("dropout") and not spec.get("post_processor")
    # added tokens that are looked for in normalised text cannot be found in the text as it is
    plain = plain and not any(t["normalized"] for t in spec["added_tokens"])
    return tokenizer, spec, plain


def _added(spec: dict):
    """``holds(text)``: whether the library would find an added token in the text."""
    contents = [t["content"] for t in spec["added_tokens"]]
    return lambda text: any(c in text for c in contents)


def _by_library(tokenizer, text: str) -> bytes:
    return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def _is_byte_level(spec: dict) -> bool:
    pre = spec["pre_tokenizer"] or {}
    return not spec["normalizer"] and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")


def _letters_of_bytes() -> dict[str, int]:
    """Byte-level files write a byte as one letter: visible bytes as themselves, the others from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _fast(path: str):
    tokenizer, spec, plain = _file(path)
    model = spec["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model.get("merges", [])]
    ranks = [model["vocab"].get(a + b, -1) for a, b in merges] if plain else []
    if not plain or not _is_byte_level(spec) or model.get("end_of_word_suffix") or ranks != sorted(set(ranks)) or -1 in ranks:
        return _loaded(Encoder, path).encode
    import tiktoken

    letters = _letters_of_bytes()
    special = {t["content"] for t in spec["added_tokens"]}
    vocabulary = {bytes(letters[c] for c in token): k for token, k in model["vocab"].items() if token not in special}
    make = lambda pattern: tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})
    single, exact = make(SINGLE_SPACES_PATTERN).encode_ordinary, make(BYTE_LEVEL_PATTERN).encode_ordinary
    holds = _added(spec)

    def encode(texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if holds(text):
                out.append(_by_library(tokenizer, text))
                continue
            rare = RARE_ASCII if text.isascii() else RARE
            runs = any(p in text for p in PAIRS) or any(c in text for c in rare)
            out.append(array("I", (exact if runs else single)(text)).tobytes())
        return out

    return encode


class _Memory(dict):
    """Ids by key, found on the first look."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, key):
        ids = self[key] = self.find(key)
        return ids


class Encoder:
    def __init__(self, path: str):
        import regex

        self.tokenizer, spec, plain = _file(path)
        pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"] or {}
        self.kind, pattern, self.holds = None, None, _added(spec)
        if plain and _is_byte_level(spec):
            self.kind, pattern = "spaces kept", BYTE_LEVEL_PATTERN
        steps = pre.get("pretokenizers", [])
        if plain and [s["type"] for s in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]:
            dropped = steps[0]["behavior"] == "Removed" and steps[0]["invert"]
            known = [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            if dropped and known and norm["normalizers"][1].get("content") == " ":
                self.kind, pattern = "spaces dropped", steps[0]["pattern"]["Regex"]
        self.split = regex.compile(pattern).findall if pattern else None
        self.cut = re.compile(r" (?=\S)").split
        self.letter = {b: c for c, b in _letters_of_bytes().items()}
        self.words, self.starts, self.pieces = _Memory(self._word), _Memory(self._start), _Memory(self._piece)

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if self.kind is None:
            return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        for memory, most in ((self.words, WORDS_KEPT), (self.starts, WORDS_KEPT), (self.pieces, PIECES_KEPT)):
            if len(memory) > most:
                memory.clear()
        return [_by_library(self.tokenizer, t) if self.holds(t) else self._by_words(t) for t in texts]

    def _by_words(self, text: str) -> bytes:
        known = self.words.__getitem__
        if self.kind == "spaces dropped":
            # only ASCII letters are lowered here: this commutes with the file's own normalisation
            return b"".join(map(known, text.encode().lower().decode().replace("\n", " ").split(" ")))
        words = self.cut(text)
        return self.starts[words[0]] + b"".join(map(known, words[1:]))

    def _word(self, word: str) -> bytes:
        if self.kind == "spaces kept":
            return self._start(" " + word)
        if not word.isascii():
            # letters below U+0130 are in normal form and have plain lower-case letters
            word = word.lower() if max(word) < "\u0130" else self.tokenizer.normalizer.normalize_str(word)
        if word.isalpha():
            return self.pieces[word]
        if word[:-1].isalpha() and word[-1] in ",.":
            return self.pieces[word[:-1]] + self.pieces[word[-1]]
        return self._start(word)

    def _start(self, chunk: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(chunk)))

    def _piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() and piece.isalpha() else "".join(map(self.letter.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()
