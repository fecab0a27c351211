"""Numeric kernels for test statistics, vectorised with numpy (no scipy here).

They run inside pandas UDFs on *aggregated* rows (one row per variant), never per raw genotype.
"""

from __future__ import annotations

import math

import numpy as np

NODES, WEIGHTS = np.polynomial.legendre.leggauss(96)


def t_two_sided_p(t, df):
    """P(|T| > |t|) for Student's t with ``df`` degrees of freedom.

    With T = sqrt(df) cot(a) the tail is proportional to the integral of sin(a)^(df - 1) from 0 to the angle of |t|. The
    integrand falls from that angle down, so the integral is taken from where it has fallen by a factor of 1e-18 (a closed
    form), by Gauss-Legendre; the whole is the beta function of (df / 2, 1 / 2), in logarithms.
    """
    t, df = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(t, df))
    ok = np.isfinite(t) & (df > 0)
    n = np.where(ok, df, 1.0)
    angle = np.arctan2(np.sqrt(n), np.abs(np.where(ok, t, 0.0)))
    top = np.log(np.sin(angle))
    power = np.maximum(n - 1, 1e-300)
    low = np.arcsin(np.exp(np.maximum(top - 41.5 / power, -700.0)))
    half = (angle - low) / 2
    at = low[..., None] + half[..., None] * (NODES + 1)
    with np.errstate(divide="ignore"):
        body = np.exp((n - 1)[..., None] * (np.log(np.sin(at)) - top[..., None]))
    norm = np.array([math.lgamma((v + 1) / 2) - math.lgamma(v / 2) - math.lgamma(0.5) for v in n.ravel()]).reshape(n.shape)
    p = 2 * half * (body * WEIGHTS).sum(-1) * np.exp((n - 1) * top + norm)
    return np.where(ok, np.minimum(p, 1.0), np.nan)
