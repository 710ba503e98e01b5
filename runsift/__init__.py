"""Which repositories have enough downloadable CI logs, and why not: Spark jobs over landed responses."""

from runsift.settings import Settings

__all__ = ["Settings"]
