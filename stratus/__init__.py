"""stratus: Spark-native analytics for station-based sensor measurements.

Raw multi-header workbooks and archives are exploded into cells on executors,
cleaned into wide station columns, melted into a tall fact, loaded
idempotently into a star schema and queried for integrity, quality, coverage
and analytics. Every step is a lazy DataFrame transformation; the driver only
assembles plans and collects final (small) report frames.
"""

from stratus.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
