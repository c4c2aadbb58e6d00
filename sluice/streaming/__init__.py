from .checks import read_checked, stream_checks, stream_session
from .gold import upsert_gold_stream
from .latest import latest_state, upsert_latest
