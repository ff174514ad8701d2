"""Query catalogue: Spark callables and their DuckDB oracle SQL.

Every query takes ``(spark, sf_dir)``, reads whole tables through the
library's own operators and returns a DataFrame whose float columns are
rounded (6 digits; 3 for fits run to convergence) so that the oracle can
compare values exactly. The SQL side uses the same column names.

Importing this package registers every query (one module per family).
"""

from . import (  # noqa: F401  (importing registers the queries)
    aggregates,
    bowl,
    evaluation,
    fits,
    penalty_queries,
    row_form,
    row_level,
    svm_queries,
    wide,
)
from .bowl import BOWL_LAMBDAS, bowl_loss
from .registry import ORACLE, QUERIES, forget_fits, register, round_half_up, rounded

__all__ = ["BOWL_LAMBDAS", "ORACLE", "QUERIES", "bowl_loss", "forget_fits", "register", "round_half_up", "rounded"]
