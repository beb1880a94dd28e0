"""Row predicates that decide whether a text is good enough."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CleaningConfig
from . import patterns as P
from .text import tokens


def length_ok(text: Column, config: CleaningConfig = CleaningConfig()) -> Column:
    return F.length(text).between(config.min_text_length, config.max_text_length)


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, f"[{P.WS}]+"), lambda w: w != ""))


def words_ok(text: Column, config: CleaningConfig = CleaningConfig()) -> Column:
    return word_count(text) >= config.min_words


def entity_density_ok(
    text: Column, has_entity: Column, config: CleaningConfig = CleaningConfig()
) -> Column:
    """False for a long text in which nothing was recognised."""
    return has_entity | (F.size(tokens(text)) <= config.max_tokens_without_entity)


def quality_ok(
    text: Column, has_entity: Column, config: CleaningConfig = CleaningConfig()
) -> Column:
    """All gates. The cheap ones come first, so that only texts of an accepted
    length are cut into tokens."""
    return F.coalesce(
        F.when(
            length_ok(text, config) & words_ok(text, config),
            entity_density_ok(text, has_entity, config),
        ).otherwise(F.lit(False)),
        F.lit(False),
    )
