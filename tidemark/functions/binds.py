"""``:NAME`` placeholders inside Spark SQL expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

# Quoted text and comments are matched first so that a colon inside them is left alone.
_TOKEN = re.compile(
    r"""
      '(?:[^'\\]|\\.|'')*'      # string literal
    | "(?:[^"\\]|\\.)*"         # string literal, double quotes
    | `[^`]*`                   # quoted identifier
    | --[^\n]*                  # line comment
    | /\*.*?\*/                 # block comment
    | (?<![:\w]):([A-Za-z_]\w*) # the placeholder
    """,
    re.VERBOSE | re.DOTALL,
)


def clean(expression: str) -> str:
    """Trim an expression and its trailing semicolons; an empty one is an error."""
    text = expression.strip()
    while text.endswith(";"):
        text = text[:-1].rstrip()
    if not text:
        raise ValueError("empty SQL expression")
    return text


def bind_names(expression: str) -> list[str]:
    """Distinct placeholder names in order of appearance, compared without case."""
    seen: dict[str, str] = {}
    for match in _TOKEN.finditer(expression):
        if match.group(1):
            seen.setdefault(match.group(1).lower(), match.group(1))
    return list(seen.values())


def bind(expression: str, column_for: Callable[[str], str]) -> str:
    """Replace each placeholder by the quoted column that ``column_for`` names."""

    def swap(match: re.Match) -> str:
        name = match.group(1)
        if not name:
            return match.group(0)
        return "`" + column_for(name).replace("`", "``") + "`"

    return _TOKEN.sub(swap, clean(expression))
