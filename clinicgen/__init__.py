"""clinicgen: seeded, relational health-care table generation on Spark.

Every table is one lazy DataFrame plan: a ``spark.range`` (or harness-table)
spine, column expressions over hash-seeded draws, and a few joins, windows and
aggregates. No driver-side row loops, no Python UDFs.
"""

from clinicgen.config import DEFAULT_CONFIG, Config, load_config
from clinicgen.session import cut_lineage, ensure_checkpoint_dir, local_session

__version__ = "0.3"  # part of a build's identity: a build begun by another version is not taken up

__all__ = ["DEFAULT_CONFIG", "Config", "load_config", "local_session", "ensure_checkpoint_dir", "cut_lineage"]
