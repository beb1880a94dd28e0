"""Scores and measures of a single text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import QualityConfig, SpecialCharacterConfig
from . import patterns as P
from .text import strip


def share_special(text: Column, ordinary: str) -> Column:
    """Characters outside of the runs of ``ordinary`` over all characters, 0 for ''."""
    special = F.length(F.regexp_replace(text, ordinary, ""))
    return F.coalesce(F.try_divide(special, F.length(text)), F.lit(0.0))


def text_quality(text: Column, config: QualityConfig = QualityConfig()) -> Column:
    """1.0 less fixed factors for special characters, shortness and repetition."""
    special = F.when(share_special(text, P.ASCII_ORDINARY) > 0.3, 0.7).otherwise(1.0)
    short = F.when(F.length(text) < config.text_length_threshold, 0.8).otherwise(1.0)
    repeats = F.when(text.rlike(P.REPEATED_CHAR), 0.9).otherwise(1.0)
    return F.when(text.isNotNull(), special * short * repeats)


def without_markup(text: Column, config: SpecialCharacterConfig = SpecialCharacterConfig()) -> Column:
    """The text less URLs and code, as far as these are excluded."""
    if config.exclude_urls:
        text = F.regexp_replace(text, P.URL_TEXT, "")
    if config.exclude_code_blocks:
        text = F.regexp_replace(text, P.FENCED_CODE, "")
        text = F.regexp_replace(text, P.INLINE_CODE, "")
    return text


def ordinary_pattern(config: SpecialCharacterConfig = SpecialCharacterConfig()) -> str:
    allowed = "".join("\\" + c for c in config.allowed_special_chars if not c.isalnum())
    return rf"[\p{{L}}\p{{N}}{P.WS}{allowed}]+"


def special_character_ratio(
    stripped: Column, config: SpecialCharacterConfig = SpecialCharacterConfig()
) -> Column:
    return share_special(stripped, ordinary_pattern(config))


def is_checkable_text(text: Column, min_chars: int = 10) -> Column:
    return F.length(strip(text)) >= min_chars
