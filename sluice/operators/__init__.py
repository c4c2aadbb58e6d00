from .checks import apply_data_checks, bad_rows, check_report, drop_keys_of, good_rows, observe_checks, split_rows, tag_rows
from .compare import (
    SchemaBreach,
    assert_frames_equal,
    assert_schema_equal,
    fits,
    frame_diff,
    frame_diff_by_digest,
    frames_equal,
    schema_breaches,
)
from .conform import map_column
from .latest import deduplicate_df, latest_per_key, not_null, require_fields, required_field_checks
from .merge import MergeBuilder, MergeConflictError, MergeTarget
from .contract import (
    contract_breaches,
    csv_value_breaches,
    file_schema_breaches,
    json_breaches,
    json_unexpected_keys,
    quarantine_files,
    write_move_log,
)
from .buckets import Buckets, read_bucketed, write_bucketed
from .publish import recover, recover_table, replace_partitions, replace_path, replace_path_parts, replace_table
