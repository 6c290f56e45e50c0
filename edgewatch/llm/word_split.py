"""The splitting patterns of byte-level vocabularies, with a faster equal form for ASCII texts."""

from __future__ import annotations

import re

import regex

#: What the Unicode classes of the patterns hold below code point 128.
ASCII_CLASSES = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}


def ascii_form(pattern: str) -> str | None:
    """The pattern with its Unicode classes as ASCII ranges; None if it holds other classes."""
    out, inside, rest = [], False, pattern
    while rest:
        name = next((x for x in ASCII_CLASSES if rest.startswith(x)), None)
        if name:
            out.append(ASCII_CLASSES[name] if inside else f"[{ASCII_CLASSES[name]}]")
            rest = rest[len(name) :]
        elif rest[:2] in (r"\p", r"\P"):
            return None
        else:
            size = 2 if rest[0] == "\\" else 1
            inside = (inside or rest[0] == "[") and rest[0] != "]"
            out.append(rest[:size])
            rest = rest[size:]
    return "".join(out)


class Splitter:
    def __init__(self, pattern: str):
        self._any = regex.compile(pattern).findall
        plain = ascii_form(pattern)
        self._ascii = re.compile(plain, re.ASCII).findall if plain else self._any

    def __call__(self, text: str) -> list[str]:
        return self._ascii(text) if text.isascii() else self._any(text)
