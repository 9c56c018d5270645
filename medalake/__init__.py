"""medalake: a retail medallion lakehouse (landing -> bronze -> silver -> gold) on Spark.

Every operator is a plain DataFrame function. Time is always an argument
(``as_of``), never ``current_timestamp()`` inside an operator, so results are
reproducible and testable against an independent SQL oracle.
"""

from medalake.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
