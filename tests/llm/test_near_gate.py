"""What banding and the gate before verification miss together."""

import math

from cinetally.llm import near_dedup as n


def test_pairs_at_the_threshold_are_hardly_missed():
    p, size = n.THRESHOLD, n.REGISTERS
    gate = sum(math.comb(size, k) * p**k * (1 - p) ** (size - k) for k in range(size + 1) if k / size < n.DOUBTFUL)
    banding = (1 - p**n.BAND_REGISTERS) ** n.BANDS
    assert gate < 2e-6 and banding + gate < 7e-5
