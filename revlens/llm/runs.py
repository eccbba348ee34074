"""Runs of consecutive items, laid end to end."""

from __future__ import annotations

import numpy as np


def runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices of consecutive runs that start at ``first`` and hold ``size`` items."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
