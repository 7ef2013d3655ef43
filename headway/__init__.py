"""Headway: transit-feed analytics as Spark jobs.

Snapshots of a GTFS-Realtime feed are decoded, landed once, modelled and
checked with the DataFrame API, in batch and in Structured Streaming.
"""

__version__ = "0.1.0"
