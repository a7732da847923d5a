"""Table names: ``a.b.c`` with optional backticks around a part."""

from __future__ import annotations

import re

from stagehouse.errors import OptionError

_PART = re.compile(r"`((?:[^`]|``)+)`|([^.`\s]+)")


def split_name(name: str) -> list[str]:
    """Split on the dots outside backticks: ``db.`odd.name` `` has two parts."""
    parts: list[str] = []
    at = 0
    while True:
        found = _PART.match(name, at)
        if found is None:
            raise OptionError(f"not a table name: {name!r}")
        quoted, plain = found.groups()
        parts.append(plain if quoted is None else quoted.replace("``", "`"))
        at = found.end()
        if at == len(name):
            return parts
        if name[at] != ".":
            raise OptionError(f"not a table name: {name!r}")
        at += 1


def is_name(text: str) -> bool:
    """False for text that cannot be a table name, such as a SELECT."""
    try:
        return bool(split_name(text))
    except OptionError:
        return False


def quote_part(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def quote_name(name: str) -> str:
    """The same name with every part in backticks, safe to put into SQL text."""
    return ".".join(quote_part(p) for p in split_name(name))


def quote_text(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
