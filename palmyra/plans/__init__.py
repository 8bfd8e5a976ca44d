from palmyra.plans.bjr import block_bjr, clean_bjr, load_bjr  # noqa: F401
from palmyra.plans.rainfall import (  # noqa: F401
    history_slice,
    initial_balance,
    monthly_rainfall,
    seed_rows,
    update_balance,
)
from palmyra.plans.weighbridge import kg_actual, load_wb_actual, prorate_netto  # noqa: F401
