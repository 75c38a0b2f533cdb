"""Match positions as columns. Everything here is built-in SQL functions.

``matches`` gives the leftmost non-overlapping matches of a Java pattern with
code point offsets: ``split`` returns what lies between the matches of the same
search that ``regexp_extract_all`` returns, so running lengths are positions.
Patterns use possessive repeats where they can, which keeps the matcher's stack
flat on very long texts.
"""

from __future__ import annotations

SPAN = "struct<start:int,end:int,hit:string>"


def quoted(pattern: str) -> str:
    """A SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(text: str, pattern: str, when: str = "true") -> str:
    """SQL for array<struct<start,end,hit>> over the string expression ``text``; empty unless ``when`` holds."""
    p = quoted(pattern)
    return f"""CASE WHEN {when} THEN aggregate(
        arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0)),
        named_struct('at', 0, 'found', cast(array() AS array<{SPAN}>)),
        (acc, x) -> named_struct(
            'at', acc.at + length(x.`0`) + coalesce(length(x.`1`), 0),
            'found', CASE WHEN x.`1` IS NULL THEN acc.found ELSE concat(acc.found, array(named_struct(
                'start', acc.at + length(x.`0`), 'end', acc.at + length(x.`0`) + length(x.`1`), 'hit', x.`1`))) END),
        acc -> acc.found) ELSE cast(array() AS array<{SPAN}>) END"""


def keep(spans: str, condition: str) -> str:
    """Spans whose hit passes; ``condition`` is SQL over ``x``."""
    return f"filter({spans}, x -> {condition})"


def named(kind: str, spans: str) -> str:
    return f"transform({spans}, x -> named_struct('kind', '{kind}', 'start', x.start, 'end', x.end))"


def joined(spans: str) -> str:
    """kind:start:end, comma-joined, of an array of (kind, start, end)."""
    return f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
