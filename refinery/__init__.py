"""refinery: PySpark batch jobs that move tables from raw to refined.

Subpackages
-----------
sources    readers: CSV, Parquet (flat, partitioned, leaf), catalog tables,
           JDBC, file inventory
sinks      writers: CSV, raw landing, partitioned Parquet with dynamic
           overwrite, compact output, extract audit
functions  column expressions: money, line totals, date parsing, tiers,
           casing verdicts
operators  DataFrame -> DataFrame steps: segmentation, refine, quality
           checks, pruning report
plans      plan inspection helpers (pushed / partition filters, files read)
catalog    database / table registration, partition refresh, schema
           evolution, statistics
streaming  incremental "new folders only" refinement on the file source
"""

from refinery.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
