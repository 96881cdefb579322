"""Retail marts and customer behaviour features on Spark."""

from basketlens.config import CategoryRoles, FeatureConfig, MaskingConfig

__all__ = ["CategoryRoles", "FeatureConfig", "MaskingConfig"]
