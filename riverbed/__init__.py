"""riverbed: Spark-native ingestion, cleansing, keyed-upsert and slowly-changing
dimension operators.

Every operator takes and returns DataFrames and is written with the public
DataFrame API so that Catalyst plans it; nothing is collected to the driver
except bounded metadata (bucket ids, a high-water mark, a manifest).
"""

from riverbed.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
