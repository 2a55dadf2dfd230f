"""Column expressions over text: coercion, blankness, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DEFAULT_MAX_TOKENS = 512
MINIMUM_TOKENS = 64
# A token is a run of letters or digits.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
# Any character that is not Unicode white space. U+001C..U+001F separate words
# in the reference semantics although they lack the White_Space property.
NON_BLANK_PATTERN = r"(?U)[^\s\x1c-\x1f]"


def text_or_empty(text: str | Column) -> Column:
    """Text as a string, with null read as the empty text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col.cast("string"), F.lit(""))


def is_scoreable(text: str | Column) -> Column:
    """True unless the text is null, empty or only white space."""
    return text_or_empty(text).rlike(NON_BLANK_PATTERN)


def tokens(text: str | Column, max_tokens: int | None = None) -> Column:
    """Array of lower-cased tokens; ``max_tokens`` keeps the first ones only."""
    found = F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(TOKEN_PATTERN), F.lit(0))
    return found if max_tokens is None else F.slice(found, 1, max_tokens)


def token_count(text: str | Column) -> Column:
    """Number of tokens of the whole text."""
    return F.size(tokens(text))
