"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: characters after which a new word starts, besides white space
WORD_DELIMITERS = r"""!?@"^#$&~_,.:;+-*%/|\[](){}<>"""

# ``initcap`` starts words at spaces only
_MISSED = "[" + "".join("\\" + c for c in WORD_DELIMITERS) + r"\t\n\x0B\f\r]"
_BREAK = "\u0001 "


def clean(c: Column) -> Column:
    """Trimmed lower-case text."""
    return F.lower(F.trim(c))


def title_case(c: Column) -> Column:
    """Trimmed text with every word capitalised, also after punctuation: ``At-Risk``.

    Text with delimiters gets a marked space behind each of them, which is taken out again after
    ``initcap``. Most names have none and are spared that.
    """
    text = F.trim(c)
    spaced = F.regexp_replace(text, f"({_MISSED})", "$1" + _BREAK)
    punctuated = F.replace(F.initcap(spaced), F.lit(_BREAK), F.lit(""))
    return F.when(text.rlike(_MISSED), punctuated).otherwise(F.initcap(text))


def row_text(*columns: Column | str) -> Column:
    """Values joined by ``|``, so that different rows give different texts, NULL among them.

    NULL is ``\\N``; backslashes and bars within a value follow a backslash.
    """

    def written(c: Column) -> Column:
        text = F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\\N"))

    return F.concat_ws("|", *[written(F.col(c) if isinstance(c, str) else c) for c in columns])
