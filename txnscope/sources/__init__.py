from txnscope.sources.tables import (  # noqa: F401
    load, txn_events, txn_orders, scored_lines, with_views, TABLES,
)
