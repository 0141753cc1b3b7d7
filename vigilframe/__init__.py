"""Security-event analytics as Spark jobs.

Sub-packages: ``functions`` (Column expressions), ``sources`` (readers, writers,
contracts), ``operators`` (DataFrame to DataFrame building blocks), ``plans``
(the tables an analyst reads) and ``streaming`` (the same work on open input).
"""

__version__ = "0.1.0"
