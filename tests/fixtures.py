"""Synthetic inputs of the feature, training and streaming tests: the input
schemas are the contract's, the filler columns and all values are ours."""

from __future__ import annotations

import numpy as np
import pandas as pd

CHANNELS = ["web", "store", "phone", "kiosk"]          # ProductCD
NETWORKS = ["blue", "green", None]                     # card4, about a third missing
POSITIVE_SHARE = 0.04


def _labels(rng: np.random.Generator, n: int, least: int = 0) -> np.ndarray:
    positives = max(least, round(POSITIVE_SHARE * n))
    return rng.permutation(np.arange(n) < positives).astype(np.int32)


def raw_transactions(n: int = 1000, seed: int = 17) -> pd.DataFrame:
    """Raw transactions: one column that is almost always null (``sparse_note``)
    and one numeric column of no special meaning (``basket_weight``)."""
    rng = np.random.default_rng(seed)
    return pd.DataFrame({
        "TransactionID": np.arange(n, dtype=np.int64),
        "TransactionDT": rng.integers(0, 90 * 86400, n),
        "TransactionAmt": rng.gamma(2.0, 40.0, n),
        "ProductCD": [CHANNELS[i] for i in rng.integers(0, len(CHANNELS), n)],
        "card4": [NETWORKS[i] for i in rng.integers(0, len(NETWORKS), n)],
        "sparse_note": np.where(np.arange(n) % 50 == 0, 7.0, np.nan),
        "basket_weight": rng.uniform(-3, 3, n),
        "isFraud": _labels(rng, n),
    })


def feature_matrix(n: int = 200, seed: int = 17, separable: bool = False) -> pd.DataFrame:
    """A numeric matrix; ``separable`` makes the label depend on the amount."""
    rng = np.random.default_rng(seed)
    label = _labels(rng, n, least=5)
    columns = {c: rng.normal(size=n) for c in ("card1", "card2")}
    return pd.DataFrame({
        "TransactionAmt": rng.normal(size=n) + (3.0 * label if separable else 0.0),
        "hour_of_day": rng.integers(0, 24, n).astype(float),
        "day_of_week": rng.integers(0, 7, n).astype(float),
        **columns, "isFraud": label})


# 2024-03-05 06:07:08 UTC, a Tuesday.
TRADE = {"e": "trade", "E": 1709618828000, "s": "ETHUSDT", "t": 777, "p": "3500.50",
         "q": "0.40", "T": 1709618828000, "m": False, "source": "binance"}
