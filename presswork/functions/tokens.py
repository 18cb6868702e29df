"""Word tokens and token windows of an article."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.constants import WINDOW_TOKENS
from presswork.functions.numbers import int_div

TOKEN_PATTERN = r"\p{L}+"


def tokens(text: Column) -> Column:
    """Lower-case words of the whole text."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def head_tokens(text: Column) -> Column:
    """Words of the first window only: what a scorer with a fixed input length sees."""
    return F.slice(tokens(text), 1, WINDOW_TOKENS)


def window_count(words: Column) -> Column:
    """Number of windows; a text without words still has one, empty, window."""
    n = F.greatest(F.size(words), F.lit(1))
    return int_div(n - 1, WINDOW_TOKENS).cast("int") + 1


def token_windows(words: Column) -> Column:
    """Array of windows, each an array of at most 512 words."""
    return F.transform(
        F.sequence(F.lit(0), window_count(words) - 1),
        lambda i: F.slice(words, i * WINDOW_TOKENS + 1, F.lit(WINDOW_TOKENS)),
    )
