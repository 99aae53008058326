"""boxwise: object-detection dataset preparation, checking, post-processing and
evaluation expressed as Spark DataFrame / SQL / Structured Streaming jobs.

Every public operator is a function ``DataFrame(s) -> DataFrame``; composition is
plain ``DataFrame.transform``.  Nothing is collected to the driver except scalar
checks (counts) that an operator documents.
"""

__all__ = ["session", "fixtures"]
