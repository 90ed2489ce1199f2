"""tidewatch: a Spark-native toolkit for monitoring news and catalogue collections.

Every operator is a plain function ``DataFrame(s) -> DataFrame`` built on Spark SQL
expressions, joins, windows and aggregates.  Time-relative operators take an explicit
``as_of`` timestamp so that results are reproducible.
"""

from tidewatch.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
