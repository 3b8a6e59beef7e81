"""kiln — medallion-style table operators for PySpark.

Operators are ``DataFrame -> DataFrame`` (or ``Column -> Column``) functions
built from the DataFrame API.  Most are lazy, so Catalyst sees one declarative
plan from the scan to the sink.  Some run jobs while the plan is built:
``upsert`` writes its source below ``spark.checkpoint.dir`` once and checks it
for ambiguity, the runners in ``plans`` write their tables, and the
training-data operators in ``llm`` store intermediate tables there.
"""

from kiln.session import build_session, scratch_root, scratch_path

__all__ = ["build_session", "scratch_root", "scratch_path"]
