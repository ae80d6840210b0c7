"""ebbflow: signed flow between keyed places over time, on Spark.

Trips (start place and time, end place and time) → cleaned trips → flow legs → bucketed deltas → balances,
alerts, rankings and profiles, in batch and with Structured Streaming. Every operator maps DataFrames to
DataFrames with built-in Spark expressions.
"""

from ebbflow.config import configure

__all__ = ["configure"]
