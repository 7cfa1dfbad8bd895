"""verdant: an entity-catalogue engine on Spark.

Every public function takes and returns DataFrames (or Columns); nothing is
collected to the driver.  The sub-packages follow the life of a catalogue:

* ``sources``   readers for snapshots, lookup tables and service dumps
* ``functions`` Column builders for normalisation and display text
* ``operators`` extract, stage, resolve, reconcile and the three layers
* ``plans``     the query surface, the gates and the publish/build plans
* ``streaming`` incremental staging of new snapshot files
"""

__version__ = "0.1.0"
