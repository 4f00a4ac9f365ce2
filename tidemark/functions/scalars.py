"""SQL snippets for mappings.

Each helper returns Spark SQL text that never raises on bad data: it gives null, and the
target's NOT NULL rule (or a mapping check) then turns the row into a failed one.
"""

from __future__ import annotations

from collections.abc import Mapping as MappingABC

DETAIL_LENGTH = 400


def joined_text(*parts: str, separator: str = " ") -> str:
    """Concatenate with null acting as empty text."""
    glue = f", '{separator}', " if separator else ", "
    return "concat(" + glue.join(f"coalesce({p}, '')" for p in parts) + ")"


def text_or(expression: str, default: str) -> str:
    """``default`` where the text is null or empty."""
    return f"coalesce(nullif({expression}, ''), '{default}')"


def date_from_parts(day: str, month: str, year: str) -> str:
    """Date from text parts; day and month may have one or two digits."""
    return f"try_to_date({joined_text(day, month, year, separator='/')}, 'd/M/yyyy')"


def rounded_product(left: str, right: str, scale: int = 2) -> str:
    return f"round(try_multiply({left}, {right}), {scale})"


def code_map(expression: str, codes: MappingABC[str, str], default: str) -> str:
    """Fixed code list to text; null and unlisted codes give ``default``."""
    pairs = ", ".join(f"'{code}', '{label}'" for code, label in codes.items())
    return f"decode({expression}, {pairs}, '{default}')"


def first_line(expression: str) -> str:
    return f"trim(substring_index({expression}, '\\n', 1))"


def cut_detail(expression: str) -> str:
    return f"substring({expression}, 1, {DETAIL_LENGTH})"
