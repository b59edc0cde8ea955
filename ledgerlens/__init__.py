"""ledgerlens: borrower-level behavioural feature tables on Spark.

Everything is expressed with the DataFrame API so Catalyst can prune, push down
and fuse the work; no Python UDF sits on the hot path.
"""

from ledgerlens.session import get_spark, ensure_checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "ensure_checkpoint_dir"]
