"""A list of SELECT statements as one source."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

# What a semicolon can stand in without ending a statement, and the semicolon itself.
_TOKEN = re.compile(
    r"""(?:\b[rR])(?:'[^']*'|"[^"]*")|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*|;""", re.DOTALL
)
_COMMENT_EDGE = re.compile(r"/\*|\*/")


class Statement(NamedTuple):
    package: str
    sql: str


def split_statements(text: str) -> list[str]:
    """Split on semicolons outside quotes and comments; pieces without a statement are dropped.

    Quotes have backslash escapes, but for raw strings; bracketed comments nest.
    """
    pieces, at, start, seen = [], 0, 0, []
    while token := _TOKEN.search(text, at):
        seen.append(text[at : token.start()])
        at = token.end()
        if token[0] == ";":
            pieces.append((text[start : token.start()], "".join(seen)))
            start, seen = at, []
        elif token[0] == "/*":
            depth = 1
            while depth and (edge := _COMMENT_EDGE.search(text, at)):
                depth += 1 if edge[0] == "/*" else -1
                at = edge.end()
            at = at if not depth else len(text)
        elif not token[0].startswith("--"):
            seen.append(token[0])
    pieces.append((text[start:], "".join([*seen, text[at:]])))
    return [piece.strip() for piece, code in pieces if code.strip()]


def statement_list(statements: str | Sequence[str]) -> list[Statement]:
    """Number the statements ``BCP_01``, ``BCP_02``, … in the order given."""
    texts = split_statements(statements) if isinstance(statements, str) else statements
    texts = [text.strip().strip(";").strip() for text in texts]
    texts = [text for text in texts if text]
    if not texts:
        raise ValueError("at least one SQL statement is needed")
    return [Statement(f"BCP_{number:02d}", text) for number, text in enumerate(texts, start=1)]
