"""Outcomes, and the columns that carry a replay.

While rows are classified, columns the library adds carry a prefix, so that a change log may
have columns called ``detail`` or ``present``. Results have the plain names.
"""

INSERTED, UPDATED, DELETED = "INSERTED", "UPDATED", "DELETED"
FAILED, LINK_FAILED = "FAILED", "LINK_FAILED"
SKIPPED_BADROW, SKIPPED_QUARANTINED = "SKIPPED_BADROW", "SKIPPED_QUARANTINED"
OUTCOMES = (INSERTED, UPDATED, DELETED, FAILED, LINK_FAILED, SKIPPED_BADROW, SKIPPED_QUARANTINED)

# Kinds of rows: routed changes, and seeds of the starting state.
INSERT, UPDATE, DELETE = "I", "U", "D"
TARGET_SEED, QUARANTINE_SEED = "T", "Q"

# Columns of a result.
KIND, OP, REASON = "kind", "op_text", "reason"
PRESENT, INSERT_FAILED = "present", "insert_failed"
OUTCOME, DETAIL, EFFECTIVE, CREATES = "outcome", "detail", "effective", "creates"
RESULT = (KIND, OP, REASON, PRESENT, INSERT_FAILED, OUTCOME, DETAIL, EFFECTIVE, CREATES)

_PREFIX = "_tm_"


def own(name: str) -> str:
    """The name of a column while rows are classified."""
    return _PREFIX + name


def value_column(name: str) -> str:
    """The reshaped value of a target column."""
    return own(f"v_{name}")


ORDER, OLD_ID, QUARANTINED = own("order"), own("old_id"), own("quarantined")
