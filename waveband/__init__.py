"""waveband: a Spark-native build of quarterly radio-audience survey statistics.

Packages:

* ``sources``   - survey tables (Parquet storage, derived test fixture)
* ``functions`` - column expressions and reach measures
* ``operators`` - staging, enrichment, summaries, control table, writes
* ``plans``     - the quarterly build job and the release-day publish job
"""

__version__ = "0.1.0"
