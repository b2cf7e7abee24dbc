"""shroud: masks, row filters and tag-driven policies for Spark DataFrames.

Controls, tags, policies, grants and entitlements are ordinary DataFrames. Masks and
filters are native Column expressions; policy resolution, the access audit and data
classification are Spark jobs (joins, aggregates, streams).
"""

__version__ = "0.1.0"
