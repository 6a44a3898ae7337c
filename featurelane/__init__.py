"""featurelane: feature-table operators on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``).  Fitted objects (vocabularies, scaler statistics) are small
DataFrames, persisted as Parquet.  Catalyst, AQE and Parquet are the engine.
"""

from featurelane.session import get_session, checkpoint_dir, cut_lineage

__all__ = ["get_session", "checkpoint_dir", "cut_lineage"]
