"""Text splitting with the semantics of the jobs being rebuilt.

The original jobs split strings with a Java-style `split(delimiter)`: inner and
leading empty pieces are kept, trailing empty pieces are dropped, an empty input
gives one empty piece, and an input made only of delimiters gives no pieces.
Spark's `split` keeps trailing empties, so the helpers below strip the trailing
delimiters first. All of it stays in JVM expressions (whole-stage codegen).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the character class Java's `\s` stands for (ASCII whitespace).
WHITESPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]"
WHITESPACE = " \t\n\x0b\f\r"

# Fixed value: line breaks recognised by Hadoop's line reader.
LINE_BREAK = "\\r\\n|\\r|\\n"


def _empty() -> Column:
    return F.array().cast("array<string>")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(c, delimiter: str = " ", regex: bool = False) -> Column:
    """Split like Java's `String.split(delimiter)` (limit 0).

    `delimiter` is a literal unless `regex=True`; a regex delimiter must match
    single characters (a character class), which is all the jobs use. Trailing
    empty pieces are cut by trimming the delimiter characters where it is one
    character (or the white-space class), else by position in the piece list;
    both take time linear in the text, whatever runs of delimiters it holds.
    """
    c = _col(c)
    none = F.lit(None).cast("array<string>")
    pattern = delimiter if regex else re.escape(delimiter)
    ends = WHITESPACE if regex and delimiter == WHITESPACE_CLASS else delimiter if not regex and len(delimiter) == 1 else None
    if ends is not None:
        stripped = F.rtrim(c, F.lit(ends))
        return F.when(c.isNull(), none).when((c != "") & (stripped == ""), _empty()).otherwise(F.split(stripped, pattern))
    pieces = F.split(c, pattern)
    filled = F.array_max(F.transform(pieces, lambda p, i: F.when(p != "", i + 1).otherwise(0)))
    return F.when(c.isNull(), none).when(c == "", F.array(F.lit(""))).otherwise(F.slice(pieces, F.lit(1), filled))


def lines_of(c) -> Column:
    """Lines of a text the way a text-file scan yields them: no trailing empty
    line after a final line break, and an empty text has no lines."""
    c = _col(c)
    body = F.regexp_replace(c, f"(?:{LINE_BREAK})\\z", "")
    return (F.when(c.isNull() | (c == ""), _empty())
            .otherwise(F.split(body, LINE_BREAK)))


def tokenize(c) -> Column:
    """Same tokens as `pyspark.ml.feature.Tokenizer`: lower-case, then a
    Java-style split on single whitespace characters."""
    return java_split(F.lower(_col(c)), WHITESPACE_CLASS, regex=True)


def strip_quotes(c) -> Column:
    """Remove every double-quote character."""
    return F.regexp_replace(_col(c), '"', "")
