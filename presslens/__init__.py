"""Reader analytics for subscription publishers, written as Spark DataFrame plans.

Every public function takes DataFrames and returns a lazy DataFrame.  The packages are

* ``functions``  column expressions (no joins, no shuffles)
* ``operators``  reusable DataFrame operators (ordered scans, range joins, rolling frames, encoders)
* ``sources``    readers and writers
* ``plans``      the reader-analytics jobs built from the two above
* ``catalog``    the queries and their SQL oracles over the test tables
"""

__version__ = "0.1.0"
