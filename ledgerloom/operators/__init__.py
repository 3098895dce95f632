from ledgerloom.operators.aggregate import (  # noqa: F401
    control_totals,
    duplicate_keys,
    first_non_null,
    grouped_sum,
    rate_summary,
    sum_and_first,
)
from ledgerloom.operators.allocate import (  # noqa: F401
    dense_sales_share,
    dense_sales_share_periods,
    dense_sales_share_sql,
    labor_allocation,
)
from ledgerloom.operators.anomaly import (  # noqa: F401
    anomaly_all_periods,
    anomaly_one_period,
    keys_without_history,
)
from ledgerloom.operators.enrich import (  # noqa: F401
    enrich_store,
    lookup,
    rate_fill,
    rate_lookup,
    role_lookup,
    role_means,
    store_directory,
    unmatched_keys,
    unmatched_rows,
)
from ledgerloom.operators.composite import (  # noqa: F401
    accounts_by_store,
    dc_costs,
    meter_rollup,
    store_costs,
    tariff_by_cost_centre,
)
from ledgerloom.operators.filldown import fill_down, sampled_chunk  # noqa: F401
from ledgerloom.operators.filters import (  # noqa: F401
    drop_empty_tagged_rows,
    filter_period,
    filter_valid_key,
)
from ledgerloom.operators.periods import DropLedger, PeriodTable  # noqa: F401
from ledgerloom.operators.quality import ObservedChecks, dq_report  # noqa: F401
from ledgerloom.operators.reshape import (  # noqa: F401
    merge_repeated_columns,
    normalize_headers,
    project_template,
    rollup_columns,
)
from ledgerloom.operators.sink import (  # noqa: F401
    conform_schema,
    replace_period,
    replace_period_frame,
    write_period,
    write_periods,
)
