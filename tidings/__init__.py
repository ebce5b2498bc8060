"""tidings: DataFrame operators that turn feeds of posts and documents into sourced topic digests.

Every public operator takes and returns Spark DataFrames. Partition keys are ``briefing_id`` and,
below it, ``cluster_id``; one job handles many digests.
"""

__version__ = "0.1.0"
