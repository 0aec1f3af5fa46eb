"""Ranges of places in numpy arrays."""

from __future__ import annotations

import numpy as np


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of every range, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)
