from palmyra.operators.balance import capped_balance  # noqa: F401
from palmyra.operators.dedupe import top1  # noqa: F401
from palmyra.operators.fill import forward_fill  # noqa: F401
from palmyra.operators.proration import netto_totals, prorate  # noqa: F401
from palmyra.operators.refresh import append, replace_all, replace_keys, replace_where  # noqa: F401
