"""adperf: Spark-native ad-performance analytics.

Per-ad features over day windows and click-count windows, order attribution,
spend-versus-revenue reporting, model evaluation and gated publishing, all as
lazy DataFrame operators built from Spark SQL, DataFrame and ML primitives.
"""

__version__ = "0.1.0"
