"""webloom: page-corpus analytics on Spark.

Pages, rules and seen-URL tables go in; DataFrame / SQL / Structured Streaming
operators extract links, expand a frontier, encode markup as element intervals,
evaluate extraction rules as joins, clean text and write versioned results.
"""

from webloom.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
