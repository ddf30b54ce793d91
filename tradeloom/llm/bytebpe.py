"""Byte-level BPE by units: a text is cut where no token can cross, and each unit is tokenized once a worker.

A pre-token holds a space only as its first character or within a run of white
space. So there is always a boundary before a space that follows a character
other than white space, and before one that stands in front of such a character.
Texts without two white-space characters around a space are cut by
``str.split``; in others only spaces between two such characters are cut.
Added tokens hold no space, so none lies across a cut; a unit that begins with
one is left with its neighbour, as the space before it may belong to a longer run.
"""

from __future__ import annotations

import functools
import os
import re
import struct
from collections.abc import Callable
from typing import Any

import regex

SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Units held by a worker before it starts anew: about 100 MB.
MEMO_UNITS = 500_000
# Fixed value: the pattern by which the tokenizer cuts a text into pre-tokens.
PRETOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# The same, with possessive repeats, which need no way back.
PLAIN_PRETOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
SHORT_RUNS = re.compile(r"\s{0,199}(?:\S{1,199}(?:\s{1,199}|$))*+")
# Up to here both regex libraries hold the same characters for letters, digits and white space (tests compare them).
SAME_CLASSES = regex.compile("[\x00-ɏ]*")


@functools.lru_cache(maxsize=4)
def tokenizer(name: str):
    """The tokenizer of a file, or of a file name among the installed public tokenizers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if not os.path.isfile(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Tokenizer.from_file(name)


class _Irregular(Exception):
    pass


class Units(dict):
    """What a function gives for each unit of text, remembered. A unit's key lacks its leading space."""

    def __init__(self, of: Callable[[str], Any], added: tuple[str, ...]):
        super().__init__()
        self.of, self.added, self.others = of, added, {}

    def __missing__(self, piece: str):
        if not piece or piece[0].isspace() or piece.startswith(self.added):
            raise _Irregular
        if len(self) >= MEMO_UNITS:
            self.clear()
        value = self[piece] = self.of(" " + piece)
        return value

    def _whole(self, unit: str):
        if unit not in self.others:
            if len(self.others) >= MEMO_UNITS // 10:
                self.others.clear()
            self.others[unit] = self.of(unit)
        return self.others[unit]

    def parts(self, text: str) -> list:
        """The values of a text's units, in order."""
        if not text:
            return []
        first, *rest = text.split(" ")
        try:
            return [self._whole(first), *map(self.__getitem__, rest)] if first else self._cut(text)
        except _Irregular:
            return self._cut(text)

    def _cut(self, text: str) -> list:
        first, *rest = SAFE_CUT.split(text)
        return [self._whole(first), *(self._whole(" " + unit) for unit in rest)]


def added_tokens(name: str) -> tuple[str, ...]:
    return tuple(t.content for t in tokenizer(name).get_added_tokens_decoder().values())


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it is printed, else the next one from U+0100 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(others)}


def ranks(name: str) -> dict[bytes, int]:
    """The vocabulary by bytes. Its merges stand in the order of their ids, so an id is a merge's rank."""
    values = {c: b for b, c in byte_letters().items()}
    added = added_tokens(name)
    return {bytes(values[c] for c in token): i for token, i in tokenizer(name).get_vocab().items() if token not in added}


@functools.lru_cache(maxsize=2)
def text_encoder(name: str) -> Callable[[str], bytes]:
    """The ids of a whole text, as little-endian 32-bit numbers.

    Plain texts are encoded by rank in one call. Those with added tokens, with characters that the libraries may class
    apart, or with a run of which one pre-token would be long, go by units.
    """
    import tiktoken

    added = added_tokens(name)
    units = Units(lambda unit: struct.pack(f"<{len(ids := by_unit(unit))}I", *ids), added)
    by_unit = unit_encoder(name)
    plain = tiktoken.Encoding("texts", pat_str=PLAIN_PRETOKENS, mergeable_ranks=ranks(name), special_tokens={})

    def encode(text: str) -> bytes:
        if not (text.isascii() or SAME_CLASSES.fullmatch(text)) or not SHORT_RUNS.fullmatch(text) or any(a in text for a in added):
            return b"".join(units.parts(text))
        return plain.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    return encode


def forget_encoders() -> None:
    """Drop the encoders that a worker holds, and what they remember."""
    for made in (text_encoder, pretoken_encoder, tokenizer):
        made.cache_clear()


@functools.lru_cache(maxsize=2)
def pretoken_encoder(name: str) -> tuple[dict[str, int], Callable[[str], list[int]]]:
    """The strings proved to encode alone as one token, with its id; and the ids of any one pre-token by merging.

    Proved by encoding every string of the vocabulary, alone. Only strings that are one pre-token count.
    """
    import tiktoken

    t = tokenizer(name)
    texts = {i: t.decode([i], skip_special_tokens=False) for i in t.get_vocab().values()}
    proved = t.encode_batch(list(texts.values()), add_special_tokens=False)
    added = added_tokens(name)
    whole = {s: i for (i, s), e in zip(texts.items(), proved, strict=True) if e.ids == [i] and s not in added and SAME_CLASSES.fullmatch(s) and PRETOKENS.fullmatch(s)}
    # A text is one piece here. Building a list of ids is the larger part of a merge, and this library does it in a
    # third of the time.
    one_piece = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks(name), special_tokens={})

    def merged(pretoken: str) -> list[int]:
        # Its time grows with the square of a piece's length, the tokenizer's does not.
        return one_piece.encode_ordinary(pretoken) if len(pretoken) <= 200 else t.encode(pretoken, add_special_tokens=False).ids

    return whole, merged


def unit_encoder(name: str) -> Callable[[str], list[int]]:
    """The ids of a unit. Units with added tokens or characters that the libraries may class apart go to the tokenizer."""
    t, added = tokenizer(name), added_tokens(name)
    whole, merged = pretoken_encoder(name)

    def of(pretoken: str) -> list[int]:
        found = whole.get(pretoken)
        return merged(pretoken) if found is None else [found]

    def ids(unit: str) -> list[int]:
        if unit in whole:
            return [whole[unit]]
        if unit[0] == " " and unit.isascii():
            # Most units are a word, or a word and one sign; no pattern is needed to cut these.
            if unit[1:].isalpha():
                return merged(unit)
            if unit[-1] in ".,;:!?" and unit[1:-1].isalpha():
                return of(unit[:-1]) + of(unit[-1])
        if not SAME_CLASSES.fullmatch(unit) or any(a in unit for a in added):
            return t.encode(unit, add_special_tokens=False).ids
        out = []
        for p in PRETOKENS.findall(unit):
            if p in whole:
                out.append(whole[p])
            else:
                out += merged(p)
        return out

    return ids
