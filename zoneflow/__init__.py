"""zoneflow: layered data-lake jobs as plain Spark DataFrame transformations.

Every operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from built-in Spark expressions; only the functions in
``zoneflow.sinks`` run actions.  Sub-packages:

* ``sources``   -- season-folder, CSV, JSON, parquet, mixed-format and catalog scans
* ``functions`` -- column expressions (names, synonyms, dates, scores, rendering)
* ``operators`` -- schema conformance, unions, merges, country fill, aggregates
* ``sinks``     -- parquet / CSV / JSON writers, partition replacement, previews
* ``plans``     -- the composite zone jobs (landing -> raw -> building -> master)
* ``streaming`` -- incremental execution of the landing ingestion
"""

from zoneflow.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
