"""Change log replay as set operations on Spark."""

from .operators.image import apply_final, final_image, merge_image
from .operators.replay import replay
from .operators.skew import SkewPolicy
from .plans.cycle import CycleResult, OrderKeyError, requeue, run_cycle, run_keyset, run_queue
from .plans.store import CommitConflict, Store
from .spec import ChangeSpec, Column, Link, Mapping, SpecError
from .streaming.micro import apply_batch, read_change_stream, run_stream

__all__ = [
    "ChangeSpec",
    "Column",
    "CommitConflict",
    "CycleResult",
    "Link",
    "Mapping",
    "OrderKeyError",
    "SkewPolicy",
    "SpecError",
    "Store",
    "apply_batch",
    "apply_final",
    "final_image",
    "merge_image",
    "read_change_stream",
    "replay",
    "requeue",
    "run_cycle",
    "run_keyset",
    "run_queue",
    "run_stream",
]
