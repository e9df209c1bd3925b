"""Column functions for text: Python-compatible line splitting, stripping, numbering.

Every function takes and returns ``pyspark.sql.Column``: regex and higher-order functions are
JVM built-ins, so no row leaves the JVM. (Higher-order functions themselves are interpreted;
what they are applied to and what follows them is still code-generated.)
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Python's character sets, written as regex classes that both
# Java regex (Spark) and RE2 (the SQL oracle) accept.
#   line breaks of str.splitlines: \n \x0b \x0c \r \x1c \x1d \x1e \x85 U+2028 U+2029
#   whitespace of str.isspace / str.strip / str.split:
#     \t \n \x0b \x0c \r \x1c-\x1f space \x85 \xa0 U+1680 U+2000-U+200A
#     U+2028 U+2029 U+202F U+205F U+3000
# ---------------------------------------------------------------------------
BREAK_CHARS = r"\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}"
WS_CHARS = (
    r"\t\n\x0b\x0c\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# One line with its end kept; no phantom empty line after a final break.
LINE_RE = rf"[^{BREAK_CHARS}]*(?:\r\n|[{BREAK_CHARS}])|[^{BREAK_CHARS}]+"
LINE_END_RE = rf"(?:\r\n|[{BREAK_CHARS}])\z"
STRIP_RE = rf"^[{WS_CHARS}]+|[{WS_CHARS}]+\z"
WS_RUN_RE = rf"[{WS_CHARS}]+"
INDENT_RE = rf"^[{WS_CHARS}]*"
COMMENT_LINE_RE = rf"^[{WS_CHARS}]*# REVIEW:"

# The review line contract, markers of a rewrite response, and the note
# appended to truncated file contents.
REVIEW_RE = r"^REVIEW:([0-9]+):\s*(.+)$"
REVIEW_PREFIX = "# REVIEW:"
FILE_START = "FILE_START"
FILE_END = "FILE_END"
TRUNCATED_NOTE = "\n\n... truncated at {n} characters"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value, use) -> Column:
    """``use(x)`` with ``x`` bound to ``value``, which is worked out once per row; null stays null.

    An expression that a lambda refers to is otherwise worked out again for every element.
    """
    return F.get(F.transform(F.array(_c(value)), lambda x: F.when(x.isNotNull(), use(x))), F.lit(0))


_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def fill(template: str, **values) -> Column:
    """A text template as a Column: ``fill("'{name}' not found in {path}", name="n", path=col)``.

    Placeholders take column names or Columns; everything else is literal text.
    """
    parts, pos = [], 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(_c(values[m.group(1)]).cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


# Split points: after CRLF, after any other break, after a CR not followed by LF.
_SPLIT_AFTER_BREAK = r"(?<=\r\n|[\n\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]|\r(?!\n))"
_BREAK = rf"\r\n|[{BREAK_CHARS}]"


def split_lines_keepends(text) -> Column:
    """``str.splitlines(keepends=True)`` as ARRAY<STRING>; NULL stays NULL.

    A zero-width split after each break keeps the ends; the only empty piece possible is
    the one after a final break (or an empty text), which ``splitlines`` does not emit.
    """
    return F.array_remove(F.split(_c(text), _SPLIT_AFTER_BREAK, -1), "")


def drop_line_end(line) -> Column:
    return F.regexp_replace(_c(line), LINE_END_RE, "")


def ends_with_break(text) -> Column:
    return F.substring(_c(text), -1, 1).rlike(f"[{BREAK_CHARS}]")


def split_lines(text) -> Column:
    """X1 without line ends: ``str.splitlines()`` (blank lines kept, no phantom last line)."""
    t = _c(text)
    parts = F.split(t, _BREAK, -1)
    return F.when((t == "") | ends_with_break(t), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def normalise_newlines(text) -> Column:
    """Text-mode read, CRLF and lone CR become LF."""
    return F.regexp_replace(_c(text), r"\r\n?", "\n")


def indent_of(line) -> Column:
    """Leading whitespace of a line *with* its end (a blank line's indent is the whole line)."""
    return F.regexp_extract(_c(line), INDENT_RE, 0)


def py_strip(text) -> Column:
    """``str.strip()`` with Python's whitespace set."""
    return F.regexp_replace(_c(text), STRIP_RE, "")


def number_lines(text) -> Column:
    """``"<n> | <line>"`` per line with ends kept, joined by newline."""
    return F.array_join(
        F.transform(
            split_lines_keepends(text),
            lambda l, i: F.concat((i + 1).cast("string"), F.lit(" | "), l),
        ),
        "\n",
    )


def summarise(text, limit: int = 120) -> Column:
    """Collapse whitespace runs to one space; cut to ``limit-3`` chars + '...'."""
    single = F.regexp_replace(F.regexp_replace(_c(text), STRIP_RE, ""), WS_RUN_RE, " ")
    return F.when(F.length(single) <= limit, single).otherwise(
        F.concat(F.substring(single, 1, limit - 3), F.lit("..."))
    )


def truncate_content(text, max_chars) -> Column:
    """Optional truncation with the trailing note; falsy limit means none."""
    t, n = _c(text), _c(max_chars)
    # Python slicing: a negative limit keeps all but the last |n| characters.
    keep = F.when(n >= 0, n).otherwise(F.greatest(F.length(t) + n, F.lit(0)))
    return F.when(
        n.isNotNull() & (n != 0) & (F.length(t) > n),
        F.concat(F.left(t, keep), fill(TRUNCATED_NOTE, n=n)),
    ).otherwise(t)


def module_key(path) -> Column:
    """Relative path minus ``.py``, slashes to dots."""
    return F.replace(F.regexp_replace(_c(path), r"\.py$", ""), F.lit("/"), F.lit("."))


def keep_final_newline(original, updated) -> Column:
    """X11: add a newline when the original ended with one and the update does not."""
    o, u = _c(original), _c(updated)
    return F.when(F.endswith(o, F.lit("\n")) & ~F.endswith(u, F.lit("\n")), F.concat(u, F.lit("\n"))).otherwise(u)


def normalise_path(path) -> Column:
    """Lexical ``.``/``..`` resolution of an absolute path ('/' joined)."""
    acc = F.aggregate(
        F.split(_c(path), "/"),
        F.lit(""),
        lambda a, s: F.when(s.isin("", "."), a)
        .when(s == "..", F.regexp_replace(a, "/[^/]*$", ""))
        .otherwise(F.concat(a, F.lit("/"), s)),
    )
    return let(acc, lambda a: F.when(a == "", F.lit("/")).otherwise(a))


def within_root(path, root: str) -> Column:
    """join to the root (absolute paths replace it), normalise, test containment."""
    return normalise_path(let(path, lambda p: F.when(F.startswith(p, F.lit("/")), p).otherwise(
        F.concat(F.lit(root.rstrip("/") + "/"), p))))


def path_digest(path) -> Column:
    """First 10 hex chars of SHA-1."""
    return F.substring(F.sha1(_c(path)), 1, 10)


def line_key(digits) -> Column:
    """Python ``int()`` identity of a digit string: leading zeros dropped, all-zero -> '0'."""
    stripped = F.regexp_replace(_c(digits), "^0+", "")
    return F.when(stripped == "", F.lit("0")).otherwise(stripped)
