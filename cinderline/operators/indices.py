"""Spectral indices as columns over the six optical bands, computed in double precision. Null bands give null."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import BRIGHTNESS, ENDMEMBERS, GREENNESS, OPTICAL, WETNESS


def _band(name: str) -> Column:
    return F.col(name).cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom; 0 where bottom is 0, null where either is null."""
    return F.when(bottom == 0, F.when(top.isNotNull(), 0.0)).otherwise(F.try_divide(top, bottom))


def normalized_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); null if either is negative."""
    return F.when((a >= 0) & (b >= 0), ratio(a - b, a + b))


def weighted(weights: list[float]) -> Column:
    total = F.lit(weights[0]) * _band(OPTICAL[0])
    for weight, name in zip(weights[1:], OPTICAL[1:]):
        total = total + F.lit(weight) * _band(name)
    return total


def index_columns() -> dict[str, Column]:
    """The thirteen indices, in the order in which they are appended."""
    blue, green, red, nir, swir1, swir2 = (_band(b) for b in OPTICAL)
    off_red, off_nir = F.lit(0.1) - red, F.lit(0.06) - nir
    return {
        "nbr": normalized_difference(nir, swir2),
        "nbr2": normalized_difference(swir1, swir2),
        "ndvi": normalized_difference(nir, red),
        "mirbi": F.lit(10.0) * swir2 - F.lit(9.8) * swir1 + F.lit(2.0),
        "bai": ratio(F.lit(1.0), off_red * off_red + off_nir * off_nir),
        "evi": ratio(F.lit(2.5) * (nir - red), nir + F.lit(6.0) * red - F.lit(7.5) * blue + F.lit(1.0)),
        "savi": ratio(F.lit(1.5) * (nir - red), nir + red + F.lit(0.5)),
        "msi": ratio(swir1, nir),
        "ndsi": normalized_difference(green, swir1),
        "ndmi": normalized_difference(nir, swir1),
        "brightness": weighted(BRIGHTNESS),
        "greenness": weighted(GREENNESS),
        "wetness": weighted(WETNESS),
    }


def add_indices(obs: DataFrame, names: list[str]) -> DataFrame:
    columns = index_columns()
    return obs.withColumns({n: columns[n] for n in names})


def add_nbr(obs: DataFrame) -> DataFrame:
    return add_indices(obs, ["nbr"])


def add_nbr_ndvi(obs: DataFrame) -> DataFrame:
    return add_indices(obs, ["nbr", "ndvi"])


def add_fire_indices(obs: DataFrame) -> DataFrame:
    return add_indices(obs, list(index_columns()))


def unmixing_weights() -> dict[str, list[float]]:
    """Least-squares weights by end member: the pseudo-inverse of the end members, a constant of the driver.

    Shade reflects nothing, so its fraction is 0 and the plain normal equations have no inverse; this is the solution of
    least norm.
    """
    inverse = np.linalg.pinv(np.array(list(ENDMEMBERS.values())).T)
    return {name: [float(x) for x in row] for name, row in zip(ENDMEMBERS, inverse)}


def clamp(x: Column, low: float, high: float) -> Column:
    """Null stays null (greatest and least alone would skip it)."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def add_ndfi(obs: DataFrame) -> DataFrame:
    """gv_frac in [0, 1] and ndfi in [-1, 1] from spectral unmixing."""
    parts = {name: weighted(w) for name, w in unmixing_weights().items()}
    rest = parts["soil"] + parts["shade"] + parts["npv"]
    ndfi = ratio(parts["gv"] - rest, parts["gv"] + parts["soil"] + parts["shade"] + parts["npv"] + F.lit(0.0001))
    return obs.withColumns({"gv_frac": clamp(parts["gv"], 0.0, 1.0), "ndfi": clamp(ndfi, -1.0, 1.0)})


def expression(obs: DataFrame, name: str, text: str, bands: dict[str, str] | None = None) -> DataFrame:
    """obs with a column from an arithmetic text over + - * / ** and names, which bands may map to columns.

    ** takes a number or name on either side or a parenthesis on its left. The text becomes a Catalyst expression.
    """
    import re

    for alias, column in (bands or {}).items():
        text = re.sub(rf"\b{re.escape(alias)}\b", f"`{column}`", text)
    power = re.compile(r"(\((?:[^()]|\([^()]*\))*\)|[`\w.]+)\s*\*\*\s*([`\w.]+)")
    while power.search(text):
        text = power.sub(r"pow(\1, \2)", text, count=1)
    return obs.withColumn(name, F.expr(text))
