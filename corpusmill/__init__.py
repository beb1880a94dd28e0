"""Text data preparation and data quality as Spark DataFrame jobs."""

from .config import AnnotationConfig, CleaningConfig, QualityConfig, SpecialCharacterConfig

__all__ = ["AnnotationConfig", "CleaningConfig", "QualityConfig", "SpecialCharacterConfig"]
