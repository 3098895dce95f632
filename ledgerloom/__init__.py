"""ledgerloom: monthly cost analytics as Spark DataFrame operators.

Layers:

* ``functions``  column expressions (parsing, null rules, calendar, periods)
* ``sources``    scans of monthly drops and of the driver test tables
* ``operators``  DataFrame -> DataFrame building blocks (aggregate, enrich,
                 fill-down, allocation, anomaly scoring, quality, sinks)
* ``plans``      the six monthly feeds composed from the operators, plus the
                 bindings of every operator to the shared test tables
* ``streaming``  file-drop ingestion that replaces the periods that arrive
"""

__version__ = "0.1.0"
