"""Distances on the ellipsoid. They iterate, which column expressions can't stop early, so numpy does it by Arrow batch."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import fixed
from .geo import EARTH_M


def inverse(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Vincenty's inverse solution in metres; great circles where it doesn't settle (nearly opposite points)."""
    f, a = fixed.WGS84_F, fixed.WGS84_A
    b = a * (1 - f)
    p, q = np.radians(lat1), np.radians(lat2)
    apart = np.radians(lon2 - lon1)
    u, v = np.arctan((1 - f) * np.tan(p)), np.arctan((1 - f) * np.tan(q))
    su, cu, sv, cv = np.sin(u), np.cos(u), np.sin(v), np.cos(v)
    lam, settled = apart.copy(), np.zeros(apart.shape, bool)
    out = np.full(apart.shape, np.nan)
    with np.errstate(invalid="ignore", divide="ignore"):
        for _ in range(rounds):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(cv * sl, cu * sv - su * cv * cl)
            cs = su * sv + cu * cv * cl
            arc = np.arctan2(ss, cs)
            sa = np.where(ss == 0, 0.0, cu * cv * sl / ss)
            c2 = 1 - sa**2
            mid = np.where(c2 == 0, 0.0, cs - 2 * su * sv / c2)
            k = f / 16 * c2 * (4 + f * (4 - 3 * c2))
            new = apart + (1 - k) * f * sa * (arc + k * ss * (mid + k * cs * (2 * mid**2 - 1)))
            w = c2 * (a**2 - b**2) / b**2
            big = 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w)))
            small = w / 1024 * (256 + w * (-128 + w * (74 - 47 * w)))
            less = small * ss * (mid + small / 4 * (cs * (2 * mid**2 - 1) - small / 6 * mid * (4 * ss**2 - 3) * (4 * mid**2 - 3)))
            done = (np.abs(new - lam) < 1e-12) | (ss == 0)
            out = np.where(done & ~settled, np.where(ss == 0, 0.0, b * big * (arc - less)), out)
            settled |= done
            if settled.all():
                break
            lam = np.where(settled, lam, new)
        h = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(apart / 2) ** 2
        return np.where(settled, out, 2 * EARTH_M * np.arctan2(np.sqrt(h), np.sqrt(np.maximum(0.0, 1 - h))))


@F.pandas_udf(DoubleType())
def ellipsoidal(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    """Metres between two points; null where a coordinate is null or off the globe."""
    xs = [s.to_numpy(dtype=float, na_value=np.nan) for s in (lon1, lat1, lon2, lat2)]
    good = (np.abs(xs[0]) <= 180) & (np.abs(xs[2]) <= 180) & (np.abs(xs[1]) <= 90) & (np.abs(xs[3]) <= 90)
    found = inverse(*(np.where(good, x, 0.0) for x in xs))
    return pd.Series(pd.arrays.FloatingArray(np.where(good, found, 0.0), ~good))
