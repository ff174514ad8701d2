"""D1, D4, D6, D7, D9, C9 in row form: one model per embedding row, no shuffle."""

from __future__ import annotations

from ...operators import row_penalties as rp
from ...sources.tables import table
from .penalty_queries import COEF_GROUPS, GROUP_T
from .registry import ORACLE, register, rounded

# --- D1, D4, D6, D7, D9, C9 in row form: one model per embedding row, no shuffle ------------



def _coef_rows(spark, sf_dir):
    return rp.coefficient_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def _row_query(name, fn, doc):
    def run(spark, sf_dir):
        return rounded(fn(_coef_rows(spark, sf_dir)))
    run.__doc__ = doc
    register(f"{name}_rows", ORACLE[name])(run)


_row_query("l2_score", rp.l2_score_rows, "D1 in row form: ½‖w‖² of every embedding model, no shuffle.")
_row_query("l1_score", rp.l1_score_rows, "D4 in row form: Σ|w| of every embedding model, no shuffle.")
_row_query("vector_norms", rp.vector_norms_rows, "C9 in row form: L2, L1 and max norm per model, no shuffle.")
_row_query("box_membership", lambda r: rp.box_membership_rows(r, -0.3, 0.3), "D9 in row form: all weights in [-0.3, 0.3], per model.")
_row_query("group_l1_score", lambda r: rp.group_l1_score_rows(r, COEF_GROUPS),
           "D6 in row form: Σ_g ‖w_g‖ per model over six groups of eight, no shuffle.")
_row_query("group_norms", lambda r: rp.group_norms_rows(r, COEF_GROUPS),
           "C9 in row form: norm and size of every group of every model, no shuffle.")
_row_query("group_l1_prox", lambda r: rp.to_long(rp.group_l1_prox_rows(r, COEF_GROUPS, GROUP_T)),
           "D7 in row form: group soft threshold at t = 0.2 inside each row, no shuffle.")
