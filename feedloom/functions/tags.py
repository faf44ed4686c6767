"""Tag patterns of log routing.

``*`` matches one dot part, ``**`` any number of parts (none included), and
``{a,b}`` either alternative; several patterns may stand side by side.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_regex(pattern: str) -> str:
    """The anchored regular expression of one or more space-separated patterns."""
    return "^(?:" + "|".join(_one(p) for p in pattern.split()) + ")$"


def _one(pattern: str) -> str:
    pieces = re.split(r"(\.\*\*|\*\*\.|\*\*|\*|\{[^}]*\})", pattern)
    regex = ""
    for piece in pieces:
        if piece == ".**":
            regex += r"(?:\..+)?"
        elif piece == "**.":
            regex += r"(?:.+\.)?"
        elif piece == "**":
            regex += r".*"
        elif piece == "*":
            regex += r"[^.]+"
        elif piece.startswith("{"):
            regex += "(?:" + "|".join(_one(p) for p in piece[1:-1].split(",")) + ")"
        else:
            regex += re.escape(piece)
    return regex


def matches_tag(tag: Column, pattern: str) -> Column:
    return tag.rlike(tag_regex(pattern))


def topic_for(tag: Column, routes: list[tuple[str, str]]) -> Column:
    """Topic of the first matching route; null where none matches."""
    chosen = F.lit(None).cast("string")
    for pattern, topic in reversed(routes):
        chosen = F.when(matches_tag(tag, pattern), F.lit(topic)).otherwise(chosen)
    return chosen


def literal_ends(pattern: str) -> tuple[str, str]:
    """The dot parts that every match of one pattern begins and ends with, joined by dots.

    A part next to ``**`` that is glued to more text does not count, as the dot
    between them may be missing in a match.
    """
    parts = pattern.split(".")
    wild = [i for i, p in enumerate(parts) if any(x in p for x in "*{}")]
    if not wild:
        return pattern, pattern
    first, last = parts[wild[0]], parts[wild[-1]]
    begin = wild[0] - (first.startswith("**") and first != "**")
    end = wild[-1] + 1 + (last.endswith("**") and last != "**")
    return ".".join(parts[:max(begin, 0)]), ".".join(parts[end:])
