"""sensorflow: sensor time-series operators on Spark DataFrames and Structured Streaming.

Modules: ``session`` (settings, checkpoint root, partition sizing), ``schemas``,
``sources``, ``functions``, ``operators``, ``sinks``, ``streaming``, ``plans``
(registered queries, their SQL oracles, end-to-end jobs).
"""

__version__ = "0.1.0"
