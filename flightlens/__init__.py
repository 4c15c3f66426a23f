"""flightlens: a Spark-native flight-delay analytics pipeline.

Landed API pages -> complete requests -> enriched flight tables -> delay
models -> estimated times merged into today's flights -> dashboard query.
"""

__version__ = "0.1.0"
