"""Column functions with the reference's scalar semantics, built from Spark expressions."""

from tessera.functions.logic import (  # noqa: F401
    all_na_rm, any_na_rm, case_when, if_else, is_na, near, r_in, xor,
)
from tessera.functions.scalars import (  # noqa: F401
    cut_breaks, cut_width_bin, floor_to, hhmm_hours, hhmm_minutes, intdiv,
    r_log, r_mod, recycle, round_even, round_multiple,
)
