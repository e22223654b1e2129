from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters after which the warehouse's INITCAP starts a new word.
WORD_DELIMITERS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def lower_trim(c: Column | str) -> Column:
    return F.lower(F.trim(_s(c)))


def upper_trim(c: Column | str) -> Column:
    return F.upper(F.trim(_s(c)))


def title_words(c: Column | str) -> Column:
    """Upper-case the first letter of each word, lower-case the rest; punctuation separates words.

    Spark's own ``initcap`` only splits on spaces, so the text is cut into runs of word characters
    and runs of delimiters, and each run gets its first character raised.
    """
    pattern = f"[^{WORD_DELIMITERS}]+|[{WORD_DELIMITERS}]+"
    runs = F.regexp_extract_all(F.lower(_s(c)), F.lit(pattern), F.lit(0))
    return F.array_join(
        F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), ""
    )


def mask_pii(c: Column | str, env: str = "dev") -> Column:
    """Outside production keep two characters at each end. Null stays null."""
    text = _s(c)
    if env == "prod":
        return text
    return F.concat(F.substring(text, 1, 2), F.lit("***"), F.substring(text, -2, 2))


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")
