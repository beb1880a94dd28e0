"""Text cleaning steps and their fixed order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CleaningConfig
from . import patterns as P
from .text import let, strip


def drop_boilerplate_words(text: Column) -> Column:
    """Delete boilerplate phrases, also inside longer words."""
    return F.regexp_replace(text, P.BOILERPLATE, "")


def cut_signature(text: Column) -> Column:
    """Delete from the first closing formula to the end of the text."""
    return F.regexp_replace(text, P.SIGNATURE, "")


def remove_boilerplate(text: Column) -> Column:
    return strip(cut_signature(drop_boilerplate_words(text)))


def collapse_blank_lines(text: Column) -> Column:
    return F.regexp_replace(text, P.BLANK_LINES, "\n\n")


def collapse_spaces(text: Column) -> Column:
    """One blank between words, none around newlines, newlines kept."""
    single = F.regexp_replace(text, P.SPACE_RUN, " ")
    return F.regexp_replace(single, P.SPACED_NEWLINE, "\n")


def standardize_format(text: Column, config: CleaningConfig = CleaningConfig()) -> Column:
    if config.fix_spacing:
        text = collapse_spaces(collapse_blank_lines(text))
    return strip(text)


def remove_control_chars(text: Column, replacement: str = "") -> Column:
    """Delete characters of the Unicode categories C*, newline and tab included."""
    return F.regexp_replace(text, P.CONTROL if replacement == "" else r"\p{C}", replacement)


def straighten_quotes(text: Column) -> Column:
    # Translating looks each character up; most texts have none to translate.
    return let(
        text,
        lambda t: F.when(t.rlike(P.MAYBE_SMART_QUOTE), F.translate(t, P.SMART_QUOTES, P.PLAIN_QUOTES)).otherwise(t),
    )


def clean_special_chars(text: Column, config: CleaningConfig = CleaningConfig()) -> Column:
    if not config.remove_special_chars:
        return text
    return straighten_quotes(remove_control_chars(text, config.control_replacement))


def clean(text: Column, config: CleaningConfig = CleaningConfig()) -> Column:
    """All steps: boilerplate, then format, then special characters."""
    if config.remove_urls:
        text = F.regexp_replace(text, P.URL_TEXT, "")
    return clean_special_chars(standardize_format(remove_boilerplate(text), config), config)
