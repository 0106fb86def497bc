"""tierlake: a bronze -> silver -> gold lakehouse and podium-model toolkit on PySpark.

Every operator is a DataFrame -> DataFrame function built from Spark built-ins,
so Catalyst sees one declarative plan per query.  Sub-packages:

* ``sources``   - strict file readers, table / snapshot readers, lineage columns
* ``sinks``     - table overwrite, keyed writes, snapshots, previews
* ``functions`` - small column-expression helpers (initcap, dates, safe division)
* ``operators`` - conform (silver), marts (gold), history features, evaluation, model
* ``plans``     - the race-shaped fixture, landing files, pipeline and query registry
* ``llm``       - training-data operators (optional: nothing else imports it)
"""

__version__ = "0.1.0"
