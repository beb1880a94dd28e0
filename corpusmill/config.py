"""Settings. Every default is a fixed value that decides results."""

from __future__ import annotations

from dataclasses import dataclass, field, fields


class _Mergeable:
    @classmethod
    def from_dict(cls, values: dict):
        """Overlay ``values`` on the defaults; keys that are no setting are ignored."""
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in (values or {}).items() if k in known})


@dataclass(frozen=True)
class CleaningConfig(_Mergeable):
    min_text_length: int = 20
    max_text_length: int = 1000
    min_words: int = 3
    max_tokens_without_entity: int = 50
    fix_spacing: bool = True
    remove_special_chars: bool = True
    # What a control character (newline included) becomes; '' glues the neighbours.
    control_replacement: str = ""
    # Opt-in step: drop URLs before the other steps.
    remove_urls: bool = False


@dataclass(frozen=True)
class QualityConfig(_Mergeable):
    min_completeness: float = 0.8
    min_consistency: float = 0.7
    min_validity: float = 0.8
    min_uniqueness: float = 0.9
    min_accuracy: float = 0.8
    min_overall_score: float = 0.75
    max_data_age_days: int = 30
    text_length_threshold: int = 10
    # True also checks validity, uniqueness and accuracy against their minimum.
    strict: bool = False
    # True counts distinct rows and texts with HyperLogLog++ inside the first
    # pass, which saves the shuffle of row digests.
    approximate_distinct: bool = False
    output_dir: str = "quality_reports"


@dataclass(frozen=True)
class SpecialCharacterConfig(_Mergeable):
    max_special_char_ratio: float = 0.3
    allowed_special_chars: tuple = (
        ".", ",", "!", "?", "-", "_", ":", ";", "(", ")", "[", "]", '"', "'",
    )
    exclude_urls: bool = True
    exclude_code_blocks: bool = True


@dataclass(frozen=True)
class AnnotationConfig(_Mergeable):
    enable_entities: bool = True
    enable_sentiment: bool = True
    enable_topics: bool = True
    enable_keywords: bool = True
    enable_language: bool = True
    enable_instruction: bool = True
    min_keyword_score: float = 0.3
    max_keywords: int = 10
    sentiment_threshold: float = 0.1
    # Language reported when no language model is supplied.
    default_language: str = "en"
    # Column functions by annotation name, added to the annotation struct.
    extra: dict = field(default_factory=dict)


# Weight of each quality dimension in the overall score.
DIMENSION_WEIGHTS = {
    "completeness": 0.2,
    "consistency": 0.15,
    "validity": 0.15,
    "uniqueness": 0.15,
    "timeliness": 0.1,
    "integrity": 0.15,
    "accuracy": 0.1,
}

QUALITY_DIMENSIONS = tuple(DIMENSION_WEIGHTS)

ANNOTATION_TYPES = ("entities", "sentiment", "topics", "keywords", "language", "instruction")


def supported_annotation_types() -> list[str]:
    return list(ANNOTATION_TYPES)
