from palmyra.functions.scalar import (  # noqa: F401
    BLOCK_CODE_LENGTH,
    CAPACITY,
    DEFAULT_BJR,
    EPOCH,
    OPENING_RESERVE,
    ET_DRY,
    ET_DRY_MAX_COUNT,
    ET_WET,
    EXCLUDED_DIVISIONS,
    clamp,
    deficit,
    evapotranspiration,
    guarded_divide,
    has_length,
    not_in_values,
    zero_as_null,
)
from palmyra.functions.periods import (  # noqa: F401
    as_date,
    date_in_year,
    in_period,
    in_year,
    last_december,
    period_index,
    period_of,
    previous_month,
)
