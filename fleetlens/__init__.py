"""fleetlens — transit fleet telemetry analytics as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` transformation. Stateless ones
serve batch and Structured Streaming alike; the ordered, per-key flows have a
skew-safe batch form (chunked scans, see ``operators.scan``) and a streaming
form built on ``transformWithStateInPandas`` (see ``streaming``).
"""

from fleetlens.settings import JobSettings

__all__ = ["JobSettings"]
__version__ = "0.1.0"
