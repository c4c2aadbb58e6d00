"""sluice: landing-to-gold data quality on Spark DataFrames.

Row checks with reasons, schema contracts over landing files with quarantine, latest record per
key, mapping enrichment, publish and MERGE, the same over Structured Streaming, and frame/schema
equality — all as DataFrame plans.
"""

from .functions import DataCheck, DataCheckClause, any_failed, fail_messages
from .operators import *  # noqa: F401,F403
from .plans import *  # noqa: F401,F403
from .sources import LandingArea, detect_files, load_data_checks, read_check_configs
from .streaming import *  # noqa: F401,F403
