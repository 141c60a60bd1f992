"""The feature matrix: one estimator that learns everything in a few aggregate passes and one
model that applies it as a single projection.

Pass 1  medians / means / modes of the raw inputs, category vocabulary
Pass 2  on imputed inputs: medians of the ratios; mean and deviation of logs and remainder
Pass 3  beside pass 2: mean and deviation of the coordinates, weighted K-Means on the scaled ones (on distinct positions only)
Pass 4  mean and deviation of imputed ratios and of the similarities; fill values of the final
        clean-up for the columns that can still be missing (on large tables the medians of pass 1 give them)
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.functions.expressions import (
    finite,
    log_plus_one,
    merge_values,
    one_hot,
    safe_ratio,
    sanitize_names,
    standardize,
)
from acreline.operators.checks import check_choice, check_clusters, require_columns, require_rows
from acreline.operators.clean import columns_of_type
from acreline.operators.cluster import bad_weights, fit_centres, similarity_columns
from acreline.operators.impute import (
    ALL_STRATEGIES,
    CATEGORY_STRATEGIES,
    CONSTANT_CATEGORY,
    CONSTANT_NUMBER,
    NUMERIC_STRATEGIES,
    fill_values,
    require_filled,
)
from acreline.operators.quantiles import between
from acreline.operators.quantiles import categories as category_counts
from acreline.session import beside

UNKNOWN_MODES = ("error", "ignore", "infrequent_if_exist")


@dataclass(frozen=True)
class FeatureSpec:
    """Which column goes through which branch. The defaults are those of the housing table."""

    # The shipped feature configuration.
    ratios: Mapping[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "bedroom_ratio": ("total_bedrooms", "total_rooms"),
            "rooms_per_house": ("total_rooms", "households"),
            "people_per_house": ("population", "households"),
        }
    )
    logs: tuple[str, ...] = ("total_bedrooms", "total_rooms", "population", "households", "median_income")
    geo: tuple[str, ...] = ("longitude", "latitude")
    clusters: int = 10
    gamma: float = 1.0
    merges: Mapping[str, Mapping[str, str]] = field(
        default_factory=lambda: {"ocean_proximity": {"ISLAND": "NEAR OCEAN"}}
    )
    numeric_strategy: str = "median"
    category_strategy: str = "most_frequent"
    unknown: str = "ignore"
    handle_inf: bool = True
    final_impute: bool = True
    final_strategy: str = "median"
    max_categories: int = 1_000

    def check(self) -> "FeatureSpec":
        check_choice(self.numeric_strategy, NUMERIC_STRATEGIES, "numeric strategy")
        check_choice(self.category_strategy, CATEGORY_STRATEGIES, "category strategy")
        check_choice(self.unknown, UNKNOWN_MODES, "unknown handling")
        check_choice(self.final_strategy, ALL_STRATEGIES, "final strategy")
        if self.geo:
            check_clusters(self.clusters)
            if len(self.geo) != 2:
                raise ValueError("two coordinates are needed")
        for name, pair in self.ratios.items():
            if len(pair) != 2:
                raise ValueError(f"ratio {name!r} needs exactly two inputs")
        return self


# --- expressions shared by fitting and applying ----------------------------------------------


def _filled(name: str, fills: Mapping[str, float]) -> Column:
    return F.coalesce(finite(F.col(f"`{name}`").cast("double")), F.lit(float(fills[name])))


def _ratio(pair: tuple[str, str], fills: Mapping[str, float]) -> Column:
    return safe_ratio(_filled(pair[0], fills), _filled(pair[1], fills))


def _category(name: str, merges: Mapping[str, Mapping[str, str]]) -> Column:
    return merge_values(F.col(f"`{name}`"), merges.get(name, {}))


def _scaled(value: Column, scale: tuple[float, float] | list[float]) -> Column:
    return standardize(value, scale[0], scale[1])


def _moments(tag: str, value: Column) -> dict[str, Column]:
    return {f"{tag}_mean": F.avg(value), f"{tag}_std": F.stddev_pop(value)}


def _scale(found: Mapping[str, Any], tag: str) -> list[float]:
    return [float(found[f"{tag}_mean"] or 0.0), float(found[f"{tag}_std"] or 0.0)]


def _point(spec: FeatureSpec) -> list[Column]:
    return [F.col(f"__scaled_{i}") for i in range(len(spec.geo))]


def with_point(df: DataFrame, spec: FeatureSpec, learned: Mapping[str, Any]) -> DataFrame:
    """Adds the scaled coordinates, so that the similarities to all centres share them."""
    fills, scales = learned["fills"], learned["scales"]
    return df.withColumns(
        {f"__scaled_{i}": _scaled(_filled(c, fills), scales[f"geo:{c}"]) for i, c in enumerate(spec.geo)}
    )


def feature_columns(spec: FeatureSpec, learned: Mapping[str, Any]) -> dict[str, Column]:
    """All feature expressions on a frame ``with_point``, by sanitised name, in branch order:
    ratios, logs, geo, categories, remainder."""
    fills, scales = learned["fills"], learned["scales"]
    named: list[tuple[str, Column]] = []
    for name, pair in spec.ratios.items():
        value = F.coalesce(_ratio(pair, fills), F.lit(float(learned["ratio_fills"][name])))
        named.append((f"{name}__{pair[0]}_per_{pair[1]}", _scaled(value, scales[f"ratio:{name}"])))
    for name in spec.logs:
        named.append((f"log__{name}", _scaled(log_plus_one(_filled(name, fills)), scales[f"log:{name}"])))
    if spec.geo:
        for name, value in similarity_columns(_point(spec), learned["centres"], spec.gamma).items():
            named.append((f"geo__{name}", _scaled(value, scales[f"sim:{name}"])))
    for name in learned["categories"]:
        value = F.coalesce(_category(name, spec.merges), F.lit(learned["category_fills"][name]))
        for known, flag in one_hot(value, learned["vocabulary"][name], spec.unknown).items():
            named.append((f"cat__{name}_{known}", flag))
    for name in learned["remainder"]:
        named.append((f"remainder__{name}", _scaled(_filled(name, fills), scales[f"rest:{name}"])))
    return dict(zip(sanitize_names([n for n, _ in named]), [c for _, c in named]))


def _fillable(spec: FeatureSpec) -> list[str]:
    """Outputs that can be missing after their branch: only ln(1 + x) of x <= -1 is."""
    return sanitize_names([f"log__{n}" for n in spec.logs])


def cleaned_columns(spec: FeatureSpec, learned: Mapping[str, Any]) -> dict[str, Column]:
    """The feature expressions after the final clean-up."""
    columns = feature_columns(spec, learned)
    for name in _fillable(spec):
        if spec.handle_inf:
            columns[name] = finite(columns[name])
        if spec.final_impute:
            columns[name] = F.coalesce(columns[name], F.lit(float(learned["final_fills"][name])))
    return columns


def _final_medians(
    train: DataFrame,
    outputs: Mapping[str, Column],
    sources: Mapping[str, str],
    middles: Mapping[str, tuple[int, float, float]],
    fills: Mapping[str, float],
    rows: int,
) -> dict[str, float]:
    """Medians of outputs that no row lacks, without a pass over the rows.

    A scaled logarithm never falls as its input grows, so the middle values of the output are the outputs of the
    input's middle values. Of an input with gaps the fill value, its median, stands in the middle then.
    """
    if not outputs:
        return {}
    ends = []
    for side in (1, 2):
        ends.append([middles[c][side] if middles[c][0] == rows else float(fills[c]) for c in sources.values()])
    middle = train.sparkSession.createDataFrame(ends, ", ".join(f"`{c}` double" for c in sources.values()))
    low, high = (r.asDict() for r in middle.select(*[v.alias(n) for n, v in outputs.items()]).collect())
    return {n: between(rows, 0.5, *sorted((low[n], high[n]))) for n in outputs}


def learn(df: DataFrame, spec: FeatureSpec, label: str | None, drop: tuple[str, ...], seed: int) -> dict[str, Any]:
    """Everything the model needs, from the given rows only (pass the training rows)."""
    spec.check()
    skip = {*drop, *([label] if label else [])}
    categories = [c for c in columns_of_type(df, numeric=False) if c not in skip]
    pairs = [c for pair in spec.ratios.values() for c in pair]
    numeric = [c for c in columns_of_type(df, numeric=True) if c not in skip]
    named = list(dict.fromkeys([*pairs, *spec.logs, *spec.geo]))
    require_columns(df, [*named, *spec.merges, *([label] if label else [])])
    remainder = [c for c in numeric if c not in named]
    inputs = list(dict.fromkeys([*named, *remainder]))
    train = df.select(*inputs, *categories, *([label] if label else []))

    # Pass 1
    raw = {c: finite(F.col(f"`{c}`").cast("double")) for c in inputs}
    weight = F.col(label).cast("double") if label and spec.geo else None
    extra = {"rows": F.count(F.lit(1))}
    if weight is not None:
        extra["bad_weights"] = bad_weights(weight)
    middles: dict[str, tuple[int, float, float]] = {}
    fills, found = fill_values(train, raw, spec.numeric_strategy, extra, middles=middles)
    rows = found["rows"]
    require_filled(fills, inputs)
    if found.get("bad_weights"):
        raise DataValidationError(f"{found['bad_weights']} targets are no usable cluster weights")
    # Pass 2 and, beside it, pass 3, which needs no more of it than the moments of the coordinates. The rows have been read
    # by now, so that frames that are kept are not made twice.
    logs = {f"log:{c}": log_plus_one(_filled(c, fills)) for c in spec.logs}
    rest = {f"rest:{c}": _filled(c, fills) for c in remainder}
    geo = {f"geo:{c}": _filled(c, fills) for c in spec.geo}
    ratios = {name: _ratio(pair, fills) for name, pair in spec.ratios.items()}

    def middle_ratios() -> tuple[dict[str, float], dict[str, Any]]:
        extra = {}
        for tag, value in {**logs, **rest}.items():
            extra |= _moments(tag, value)
        return fill_values(train, ratios, spec.numeric_strategy, extra, rows)

    def clusters() -> tuple[dict[str, list[float]], DataFrame, list[Any]]:
        if not spec.geo:
            return {}, train, []
        found = train.agg(*[c.alias(k) for tag, value in geo.items() for k, c in _moments(tag, value).items()]).first()
        placed = {tag: _scale(found, tag) for tag in geo}
        points = with_point(train, spec, {"fills": fills, "scales": placed})
        return placed, points, fit_centres(points, *_point(spec), weight, spec.clusters, seed, check=False)

    with beside(df.sparkSession, middle_ratios) as ratio_result, beside(df.sparkSession, clusters) as cluster_result:
        merged = {c: _category(c, spec.merges) for c in categories}
        counts = category_counts(train, merged, spec.max_categories)
        words = {c: list(n) for c, n in counts.items()}
        if spec.category_strategy == "constant":
            category_fills = {c: CONSTANT_CATEGORY for c in categories}
            gappy = [c for c in categories if sum(counts[c].values()) < rows]
            words |= {c: sorted({*words[c], CONSTANT_CATEGORY}) for c in gappy}
        else:
            # The first of the most frequent values in sorted order.
            category_fills = {c: max(n, key=n.get) for c, n in counts.items() if n}
        require_filled(category_fills, categories)
        ratio_fills, found = ratio_result()
        require_filled(ratio_fills, list(ratios))
        placed, train, centres = cluster_result()
    scales = {tag: _scale(found, tag) for tag in (*logs, *rest)} | placed
    similar = {f"sim:{n}": c for n, c in similarity_columns(_point(spec), centres, spec.gamma).items()}

    # Pass 4
    imputed = {f"ratio:{n}": F.coalesce(c, F.lit(float(ratio_fills[n]))) for n, c in ratios.items()}
    extra = {}
    for tag, value in {**imputed, **similar}.items():
        extra |= _moments(tag, value)
    outputs = {}
    if spec.final_impute:
        outputs = {
            name: finite(_scaled(logs[f"log:{c}"], scales[f"log:{c}"]))
            for name, c in zip(_fillable(spec), spec.logs)
        }
    if spec.final_strategy != "median" or not all(c in middles for c in spec.logs):
        final_fills, found = fill_values(train, outputs, spec.final_strategy, extra, rows)
    else:
        extra |= {f"known:{name}": F.count(value) for name, value in outputs.items()}
        found = fill_values(train, {}, spec.final_strategy, extra)[1]
        whole = [name for name in outputs if found[f"known:{name}"] == rows]
        final_fills = _final_medians(train, {n: outputs[n] for n in whole}, dict(zip(outputs, spec.logs)), middles, fills, rows)
        gappy = {name: value for name, value in outputs.items() if name not in whole}
        final_fills |= fill_values(train, gappy, spec.final_strategy, {}, rows)[0]
    scales |= {tag: _scale(found, tag) for tag in (*imputed, *similar)}
    return {
        "fills": fills,
        "ratio_fills": ratio_fills,
        "category_fills": category_fills,
        "final_fills": {n: final_fills.get(n, CONSTANT_NUMBER) for n in outputs},
        "vocabulary": words,
        "categories": categories,
        "remainder": remainder,
        "centres": [list(c) for c in centres],
        "scales": scales,
    }


# --- the ML stages ---------------------------------------------------------------------------


class _FeatureParams(Params):
    spec = Param(Params._dummy(), "spec", "branch configuration", TypeConverters.identity)
    labelCol = Param(Params._dummy(), "labelCol", "target column, also the cluster weight", TypeConverters.toString)
    dropCols = Param(Params._dummy(), "dropCols", "columns that are no features", TypeConverters.toListString)
    seed = Param(Params._dummy(), "seed", "seed of the clustering", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(spec=asdict(FeatureSpec()), labelCol="", dropCols=[], seed=42)

    def feature_spec(self) -> FeatureSpec:
        # Lists instead of tuples when the stage was read back from disk; that is fine here.
        return FeatureSpec(**self.getOrDefault("spec"))


class TabularFeatures(Estimator, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the feature matrix. ``labelCol`` weights the clusters; without it they are unweighted."""

    @keyword_only
    def __init__(self, spec=None, labelCol="", dropCols=None, seed=42):
        super().__init__()
        self._set(spec=asdict(spec or FeatureSpec()), labelCol=labelCol, dropCols=list(dropCols or []), seed=seed)

    def _fit(self, dataset: DataFrame) -> "TabularFeaturesModel":
        require_rows(dataset, "training data")
        learned = learn(
            dataset,
            self.feature_spec(),
            self.getOrDefault("labelCol") or None,
            tuple(self.getOrDefault("dropCols")),
            self.getOrDefault("seed"),
        )
        model = TabularFeaturesModel()
        self._copyValues(model)
        return model._set(learned=learned)


class TabularFeaturesModel(Model, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the feature columns to a frame: map-only."""

    learned = Param(Params._dummy(), "learned", "learned statistics", TypeConverters.identity)

    def statistics(self) -> dict[str, Any]:
        return self.getOrDefault("learned")

    def columns(self) -> dict[str, Column]:
        return cleaned_columns(self.feature_spec(), self.statistics())

    def feature_names(self) -> list[str]:
        return list(self.columns())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.select_features(dataset, *dataset.columns)

    def select_features(self, dataset: DataFrame, *keep: str) -> DataFrame:
        """Only the feature matrix, and the columns to keep beside it."""
        ready = with_point(dataset, self.feature_spec(), self.statistics())
        return ready.select(*[F.col(f"`{k}`") for k in keep], *[c.alias(n) for n, c in self.columns().items()])
