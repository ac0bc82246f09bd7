"""gaugeflow: sensor-table analytics as lazy PySpark DataFrame operators.

Sub-packages:

* ``sources``   scans and sinks (delimited, JSON, XML, HTML tables, text, fixed-width binary, streams)
* ``functions`` column expressions (labels, numbers, text, bytes, arrays, clock)
* ``operators`` DataFrame -> DataFrame operators (schema, filters, quality, statistics, ranking, changes, scoring)
* ``learning``  splits, scaling, regression, classification, clustering, validation, model comparison
* ``streaming`` the same operators over Structured Streaming
* ``plans``     the end-to-end jobs, composed from the operators
* ``queries``   every operator applied to the driver tables, with equivalent SQL
"""
