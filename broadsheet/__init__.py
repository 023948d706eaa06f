"""Build, audit and model labelled headline corpora with PySpark DataFrames."""

from broadsheet.config import CleaningOptions, SiteRule, SITE_RULES, SITE_SUFFIXES
from broadsheet.session import build_session

__all__ = ["CleaningOptions", "SiteRule", "SITE_RULES", "SITE_SUFFIXES", "build_session"]
