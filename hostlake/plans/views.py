"""Spark SQL access: lake tables and derived views as temporary views.

Users who write SQL against the lake get the same names as the table
definitions; the views are the DataFrame functions of this package, so
Catalyst plans SQL and DataFrame use the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import profile as P


def register_views(spark: SparkSession, hist: DataFrame, items: DataFrame, inv: DataFrame, as_of: int,
                   agent_tables: dict[str, DataFrame] | None = None) -> list[str]:
    """Create / replace temp views; returns their names."""
    views = {
        "zabbix_history": hist,
        "zabbix_items": items,
        "zabbix_inventory": inv,
        "v_zabbix_history_readable": P.readable_history(hist, items, inv),
        "v_zabbix_host_item_catalog": P.host_item_catalog(hist, items, inv, as_of),
    }
    views.update(agent_tables or {})
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
