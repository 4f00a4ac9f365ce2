from .binds import bind, bind_names, clean
from .scalars import (
    code_map,
    cut_detail,
    date_from_parts,
    first_line,
    joined_text,
    rounded_product,
    text_or,
)

__all__ = [
    "bind",
    "bind_names",
    "clean",
    "code_map",
    "cut_detail",
    "date_from_parts",
    "first_line",
    "joined_text",
    "rounded_product",
    "text_or",
]
