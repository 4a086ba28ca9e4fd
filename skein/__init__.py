"""skein: event-time sensor analytics on Spark.

One pipeline, ``decode -> clean -> enrich -> window -> emit``, where every
stage is a ``DataFrame -> DataFrame`` function that works on batch and on
Structured Streaming input.  The four job variants are configurations of
that pipeline (see :mod:`skein.config`).
"""

from skein.config import EngineConfig, JOBS

__all__ = ["EngineConfig", "JOBS"]
