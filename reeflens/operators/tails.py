"""Tail areas of the F and t distributions for use in ``mapInPandas``."""

from __future__ import annotations


def beta_function():
    """The regularised incomplete beta function of arrays (x, a, b).

    The continued fraction is evaluated from its 400th term up, on the side of
    the mean where it converges fast.  The function refers to nothing outside
    itself, so workers need no package.
    """

    def beta(x, a, b):
        from math import lgamma

        import numpy as np

        swap = x > (a + 1) / (a + b + 2)
        x, a, b = np.where(swap, 1 - x, x), np.where(swap, b, a), np.where(swap, a, b)
        tail = np.ones_like(x)
        for i in range(400, 0, -1):
            h = i // 2
            if i % 2:
                step = -(a + h) * (a + b + h) / ((a + 2 * h) * (a + 2 * h + 1))
            else:
                step = h * (b - h) / ((a + 2 * h - 1) * (a + 2 * h))
            tail = 1 + step * x / tail
        log_b = np.array([lgamma(p) + lgamma(q) - lgamma(p + q) for p, q in zip(a, b)])
        inside = (x > 0) & (x < 1)
        safe = np.where(inside, x, 0.5)
        part = np.where(inside, np.exp(a * np.log(safe) + b * np.log1p(-safe) - log_b) / (a * tail), x >= 1)
        return np.where(swap, 1 - part, part)

    return beta


def f_tail_function():
    """P(F > f) of arrays (f, d1, d2)."""
    beta = beta_function()

    def tail(f, d1, d2):
        return beta(d2 / (d2 + d1 * f), d2 / 2, d1 / 2)

    return tail
