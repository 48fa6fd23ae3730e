"""Splitting text as the pre-tokenizers of the public vocabulary files do.

Texts in Latin script up to U+017F (without U+0130, whose lower case is two characters) take a
pattern of the standard library with spelled-out classes. All others are split by the vocabulary's
own pre-tokenizer, since Unicode versions differ between libraries.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

# Letters, numbers and white space below U+0180.
LETTER = "A-Za-zªµºÀ-ÖØ-öø-ſ"
NUMBER = "0-9²³¹¼-¾"
SPACE = "\t-\r \u0085 "
CONTRACTION = "'s|'t|'re|'ve|'m|'ll|'d"

OTHER_SCRIPT = re.compile("[^\\x00-įı-ſ]")
#: Byte-level: a leading blank stays with its word.
BLANK_LED = re.compile(
    f"{CONTRACTION}| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
    f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: Words with ends: white space is dropped, digits stand alone.
WORD_END = re.compile(f"{CONTRACTION}|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies (the published rule)."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def word_tokenizer(path: str):
    """The vocabulary's model alone: merges words that are normalized already and stand between the stand-ins of a blank."""
    from tokenizers import Tokenizer, pre_tokenizers

    found = Tokenizer(tokenizer(path).model)
    found.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(byte_symbols()[0x20])
    return found


@lru_cache(maxsize=4)
def vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@lru_cache(maxsize=4)
def special_pattern(path: str) -> re.Pattern:
    """Matches the vocabulary's special strings inside a text."""
    names = [t["content"] for t in vocabulary(path)["added_tokens"]]
    return re.compile("|".join(map(re.escape, sorted(names, key=len, reverse=True))) or "(?!)")


def blank_led(text: str, path: str) -> list[str]:
    if OTHER_SCRIPT.search(text) is None:
        return BLANK_LED.findall(text)
    spans = tokenizer(path).pre_tokenizer.pre_tokenize_str(text)
    return [text[a:b] for _, (a, b) in spans]
