"""Point-of-sale receipt monitoring as Spark DataFrame plans.

Sub-packages follow the life of a weekly run:

* ``sources``   - raw tables to canonical extracts, and generic readers
* ``operators`` - preparation, the ten metrics, flagging, quality, reporting, export
* ``sinks``     - working, historical and quality tables
* ``functions`` - column expressions (calendar, keys, lookups)
* ``plans``     - a whole week, end to end
"""

from tillwatch.params import KpiRule, Params

__all__ = ["KpiRule", "Params"]
