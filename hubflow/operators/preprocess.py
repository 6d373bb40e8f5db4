"""Preprocessing fitted on training rows: gaps get the median, values are capped at the 99th percentile.

The fit asks ``wide_quantiles`` once for all features, so no task holds a whole column; what comes back is two
numbers per feature.  They enter the transform as literals: one projection, no join.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.functions.exprs import finite_or_null, safe_ratio
from hubflow.operators.quantiles import wide_quantiles

ROUTE_PREFIX = "route_type_"


class Artifact:
    """What a fit knows: ``limits`` maps each feature to (fill, cap), either of which may be None, and
    ``scalars`` holds the values that scoring needs besides (see ``DEFAULTS``)."""

    DEFAULTS = {"osrm_minutes_per_km": 1.0, "residual_std": 0.0, "osrm_time_median": 0.0}

    def __init__(self, limits: dict, **scalars):
        self.limits = dict(limits)
        self.scalars = {name: float(scalars.get(name) or default) for name, default in self.DEFAULTS.items()}

    def __getattr__(self, name: str):
        if name in type(self).DEFAULTS:
            return self.scalars[name]
        raise AttributeError(name)

    def __eq__(self, other) -> bool:
        return isinstance(other, Artifact) and self.stored() == other.stored()

    def with_scalars(self, **scalars) -> Artifact:
        return Artifact(self.limits, **self.scalars | scalars)

    @property
    def feature_columns(self) -> list:
        return list(self.limits)

    @property
    def route_type_columns(self) -> list:
        return sorted(name for name in self.limits if name.startswith(ROUTE_PREFIX))

    @property
    def fill_values(self) -> dict:
        return {name: fill for name, (fill, _) in self.limits.items()}

    @property
    def clip_upper(self) -> dict:
        return {name: cap for name, (_, cap) in self.limits.items()}

    def stored(self) -> dict:
        """The fit under its stored names."""
        return {key: getattr(self, key) for key in S.ARTIFACT_KEYS}

    @classmethod
    def restore(cls, stored: dict) -> Artifact:
        names, fills, caps, _, *scalars = (stored[key] for key in S.ARTIFACT_KEYS)
        return cls({n: (fills.get(n), caps.get(n)) for n in names}, **dict(zip(cls.DEFAULTS, scalars)))

    def to_json(self) -> str:
        return json.dumps(self.stored(), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Artifact:
        return cls.restore(json.loads(text))

    def to_frame(self, spark) -> DataFrame:
        """One row under the stored names (maps for the values of features)."""
        kinds = ["array<string>", "map<string,double>", "map<string,double>", "array<string>", "double", "double", "double"]
        return spark.createDataFrame([tuple(self.stored().values())], ", ".join(map(" ".join, zip(S.ARTIFACT_KEYS, kinds))))


def fit_preprocessor(train: DataFrame, feature_columns: list[str]) -> Artifact:
    """Median and 99th percentile of each listed feature that ``train`` has, and the medians of OSRM minutes per
    kilometre and of OSRM time."""
    names = [c for c in feature_columns if c in train.columns]
    extra = {}
    if "osrm_time" in train.columns:
        extra["_osrm_time"] = F.col("osrm_time").cast("double")
        if "osrm_distance" in train.columns:
            extra["_minutes_per_km"] = safe_ratio(F.col("osrm_time"), F.col("osrm_distance"))
    if not names and not extra:
        return Artifact({})
    row = wide_quantiles(train.select(*names, *[x.alias(n) for n, x in extra.items()]), [*names, *extra],
                         [0.5, S.CLIP_QUANTILE]).first().asDict()
    pair = lambda name: tuple(row.get(f"q_{name}") or (None, None))
    return Artifact({n: pair(n) for n in names}, osrm_minutes_per_km=pair("_minutes_per_km")[0], osrm_time_median=pair("_osrm_time")[0])


def _ready(name: str, present: bool, limits: tuple) -> Column:
    fill, cap = limits
    value = finite_or_null(F.col(name).cast("double")) if present else F.lit(0.0)
    if fill is not None:
        value = F.coalesce(value, F.lit(fill))
    return (value if cap is None else F.least(value, F.lit(cap))).alias(name)


def transform_features(df: DataFrame, art: Artifact, keep: list[str] | None = None) -> DataFrame:
    """The fitted features, ready for a model, behind the ``keep`` columns that ``df`` has.

    A route type that the frame does not know counts 0; any other fitted feature must be there.
    """
    have = set(df.columns)
    lacking = set(art.limits) - have - set(art.route_type_columns)
    if lacking:
        raise ValueError(f"fitted features that the frame lacks: {sorted(lacking)}")
    passed = [c for c in keep or () if c in have and c not in art.limits]
    return df.select(*passed, *[_ready(name, name in have, limits) for name, limits in art.limits.items()])


def sanitize_global(df: DataFrame, train: DataFrame, feature_columns: list[str]) -> DataFrame:
    """Analyst variant: gaps get the medians of all rows, caps come from the training rows."""
    fills, caps = fit_preprocessor(df, feature_columns), fit_preprocessor(train, feature_columns)
    both = Artifact({n: (fill, caps.clip_upper.get(n)) for n, fill in fills.fill_values.items()})
    return transform_features(df, both, [c for c in df.columns if c not in both.limits])


def standardize(df: DataFrame, columns: list[str], fit: DataFrame | None = None) -> DataFrame:
    """z-score with the population std of ``fit`` (default: ``df``); constant columns -> 0."""
    src = fit if fit is not None else df
    moments = src.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(f"_z{i}") for i, c in enumerate(columns)])
    scaled = {c: F.when(F.col(f"_z{i}.std") > 0, (F.col(c) - F.col(f"_z{i}.mean")) / F.col(f"_z{i}.std")).otherwise(F.lit(0.0))
              for i, c in enumerate(columns)}
    return df.crossJoin(F.broadcast(moments)).withColumns(scaled).drop(*[f"_z{i}" for i in range(len(columns))])
