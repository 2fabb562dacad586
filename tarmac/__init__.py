"""tarmac: on-time flight analytics as Spark DataFrame operators.

Subpackages: ``sources`` (scans, sinks, dimensions, written scratch tables),
``functions`` (derived columns), ``operators`` (cleaning, summaries,
distributions, relationships, network, scoring, segmentation, prediction),
``plans`` (named queries and their oracle SQL), ``streaming`` (file-stream form).
"""

__version__ = "0.1.0"
