"""Parameter fixtures of the catalogue queries (weights, λ values, grids).

These are parameters, not data: every query that uses them still reads a
whole table. Fixed values are listed here together.
"""

from __future__ import annotations

import numpy as np

# Starting weights and penalty levels used by the queries.
W_BIN = (0.1, -0.2, 0.3, 0.05)
W_REG = (0.2, -0.1, 0.05, 0.3)
W_HINGE = (3.0, -4.0, 1.5, 2.0)  # margins on both sides of 1
LAMBDA_L2 = 0.01
LAMBDAS_REG2 = (0.01, 0.1, 0.25, 0.3)  # the last one zeroes coefficients
N_ITER = 2000
TOL = 1e-6
LR_BIN = 3.5  # below 1/L of the mean logistic loss on BIN
LR_MULTI = 1.9  # below 1/L of the mean softmax loss on MULTI
GRID_POINTS = 22
GRID_W1 = (-2.0, 2.0)
GRID_W2 = (-1.0, 3.0)
ARMIJO_C1 = 0.3
ARMIJO_RHO = 0.9


def w_multi(n_classes: int = 3, d: int = 4, a: float = 0.1, b: float = 0.05) -> list[list[float]]:
    """W_MULTI: weight = a (class_id + 1) - b feature_id (a = 0.1, b = 0.05)."""
    return [[a * (c + 1) - b * (j + 1) for j in range(d)] for c in range(n_classes)]


def grid(points: int = GRID_POINTS, w1=GRID_W1, w2=GRID_W2) -> list[tuple[int, int, float, float]]:
    """GRID: (cell_i, cell_j, w1, w2) over a points x points mesh, as linspace/meshgrid."""
    a = np.linspace(w1[0], w1[1], points)
    b = np.linspace(w2[0], w2[1], points)
    return [(i, j, float(a[j]), float(b[i])) for i in range(points) for j in range(points)]
