from .checks import (
    DataCheck,
    DataCheckClause,
    any_failed,
    check_condition,
    clauses_of,
    empty_messages,
    fail_messages,
    validate_checks,
)
