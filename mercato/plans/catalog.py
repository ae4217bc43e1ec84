"""Imports every module that registers queries."""

from mercato.plans import (reg_io, reg_measures, reg_quality, reg_reviews, reg_stats, reg_streaming,  # noqa: F401
                           reg_study)
