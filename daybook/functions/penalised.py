"""Maximum a posteriori fit of a small linear model from its sufficient statistics.

Model: values are normal around X b with unknown spread; some coefficients have a normal prior,
others a Laplace prior, and the spread has a half-normal prior. Only X'X, X'y, y'y and the number
of points are needed.
"""

from __future__ import annotations

import numpy as np

# Fixed value: scale of the half-normal prior of the spread.
SPREAD_PRIOR = 0.5

ROUNDS = 500
TOLERANCE = 1e-11


def _best_on_path(hessian, target, penalty, old, new):
    """The best point between ``old`` and ``new`` among ``new`` and all changes of sign."""
    with np.errstate(divide="ignore", invalid="ignore"):
        crossings = old / (old - new)
    inside = crossings[(penalty > 0) & (crossings > 0) & (crossings < 1)]
    points = [new]
    for step in inside:
        point = old + step * (new - old)
        point[np.isclose(crossings, step, rtol=0, atol=1e-15)] = 0.0
        points.append(point)
    costs = [0.5 * p @ hessian @ p - target @ p + penalty @ np.abs(p) for p in points]
    return points[int(np.argmin(costs))]


def lasso(hessian: np.ndarray, target: np.ndarray, penalty: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Minimises b'Hb/2 - t'b + sum(penalty |b|), by feature-sign search (Lee et al., 2007)."""
    beta = start.copy()
    free = penalty == 0
    slack = 1e-9 * max(1.0, float(np.max(np.abs(target))))
    for _ in range(50 * len(beta)):
        gradient = hessian @ beta - target
        signs = np.sign(beta)
        active = free | (beta != 0)
        settled = np.all(np.abs(gradient + penalty * signs)[active] <= slack)
        if settled:
            excess = np.where(active, -np.inf, np.abs(gradient) - penalty)
            worst = int(np.argmax(excess))
            if excess[worst] <= slack:
                break
            active[worst] = True
            signs[worst] = -np.sign(gradient[worst])
        at = np.flatnonzero(active)
        part = hessian[np.ix_(at, at)]
        solved = np.linalg.lstsq(part, (target - penalty * signs)[at], rcond=None)[0]
        beta[at] = _best_on_path(part, target[at], penalty[at], beta[at], solved)
    else:
        raise ArithmeticError("the search for the signs of the coefficients did not end")
    return beta


def fit(
    gram: np.ndarray,
    xty: np.ndarray,
    yty: float,
    points: float,
    normal_scale: np.ndarray,
    laplace_scale: np.ndarray,
) -> np.ndarray:
    """Coefficients. The two scales hold one prior scale per feature, infinite where the feature
    has no prior of that kind. Fits coefficients and spread in turn until neither moves."""
    ridge, weight = np.diag(normal_scale**-2.0), 1.0 / laplace_scale
    prior = SPREAD_PRIOR**-2
    beta, variance = np.zeros(len(xty)), 1.0
    for _ in range(ROUNDS):
        beta = lasso(gram + variance * ridge, xty, variance * weight, beta)
        residual = max(yty - 2 * xty @ beta + beta @ gram @ beta, 0.0)
        previous, variance = variance, max(
            (np.sqrt(points**2 + 4 * prior * residual) - points) / (2 * prior), 1e-12
        )
        if abs(variance - previous) <= TOLERANCE * previous:
            return beta
    raise ArithmeticError(f"the spread of a fit did not settle within {ROUNDS} rounds")
