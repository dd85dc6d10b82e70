"""ledgerlake: a Spark-native retail sales medallion pipeline.

Raw all-string extracts (customers, products, sales orders) are landed as
bronze, cleaned and typed into silver, joined into one enriched sales fact,
and aggregated into gold marts, window results, SQL forms, data-quality
tables and a JSON sales-event feed. Every step is a ``DataFrame -> DataFrame``
function so Catalyst sees one plan per result.
"""

from ledgerlake.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
