"""pillbox: prescription-centred healthcare analytics on Spark DataFrames.

Layers (all lazy DataFrame plans, Catalyst does the physical work):

* ``sources``   typed CSV scan, table reads, pruned fact reads, test-data adapter
* ``functions`` column-level helpers (string normalisation, safe casts, keys)
* ``operators`` rule engine with audit, dedupe, staging, data tests, star join,
                sinks (overwrite / append / upsert / schema guard), analyses
* ``plans``     declarative table specs and the end-to-end pipeline
* ``streaming`` incremental (available-now) cleaning of newly landed files
"""

from pillbox.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
