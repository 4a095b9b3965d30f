"""Python twins of a few text rules, for use inside batch functions and on the driver."""

from __future__ import annotations

import re

_ESCAPED = re.compile(r'\\([nrt\\"/])')
_PLAIN = {"n": "\n", "r": "\r", "t": "\t"}


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN.get(m[1], m[1]), text)


def call_partitions(wanted: int, total: int) -> int:
    """Partitions for calls: at least one, and no more than there are calls."""
    return min(max(wanted, 1), max(total, 1))
