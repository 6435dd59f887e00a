"""hostlake: a PySpark-native lake for infrastructure-monitoring data.

Main entry points (all take / return DataFrames):

* loading:    ``operators.sinks.load_pending``, ``streaming.streams.stream_load_pending``
* agent data: ``operators.normalize.normalize`` / ``route`` / ``to_table_rows``
* reports:    ``plans.reports.cpu_mem_report`` / ``disk_report``
* time match: ``operators.asof.nearest_join`` / ``bucket_join`` / ``latest_by``
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
