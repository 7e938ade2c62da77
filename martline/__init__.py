"""martline: a PySpark-native retail sales warehouse.

Entry points:

* ``martline.jobs.build_warehouse(spark, sf_dir, out, via_stream=...)`` —
  the whole build (staging, dimensions, facts, quality) as written tables;
* ``martline.catalog.QUERIES`` — every query by name, as lazy DataFrames;
* ``martline.streaming.consumer.run(...)`` — a streaming consumer into a
  keyed upsert table;
* ``martline.session.cluster_conf(input_bytes, cores)`` — cluster settings.
"""
