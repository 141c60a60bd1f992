"""Column contracts: coerce, check every rule, report every violation in one scan."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.functions.expressions import cast_or_null

REPORT_SCHEMA = "row_id string, `column` string, `check` string, failure_case string"


@dataclass(frozen=True)
class ColumnRule:
    """What one column must look like. Bounds and lists do not apply to missing values."""

    name: str
    type_name: str
    nullable: bool = True
    at_least: float | None = None
    at_most: float | None = None
    above: float | None = None
    one_of: tuple[str, ...] | None = None

    def checks(self) -> Iterator[tuple[str, Column]]:
        """(name of the check, condition that marks a violation), on raw input."""
        raw = F.col(f"`{self.name}`")
        value = cast_or_null(raw, self.type_name)
        if self.type_name == "double":
            value = F.nanvl(value, F.lit(None).cast("double"))
            absent = raw.isNull() | F.isnan(cast_or_null(raw, "double"))
        else:
            absent = raw.isNull()
        yield f"type:{self.type_name}", raw.isNotNull() & cast_or_null(raw, self.type_name).isNull()
        if not self.nullable:
            yield "not_null", absent
        if self.at_least is not None:
            yield f"ge:{self.at_least:g}", value < F.lit(self.at_least)
        if self.at_most is not None:
            yield f"le:{self.at_most:g}", value > F.lit(self.at_most)
        if self.above is not None:
            yield f"gt:{self.above:g}", value <= F.lit(self.above)
        if self.one_of is not None:
            yield "isin", ~value.isin(list(self.one_of))


@dataclass(frozen=True)
class Contract:
    """Rules for a table. ``strict`` forbids columns that have no rule (column order is free)."""

    rules: tuple[ColumnRule, ...]
    strict: bool = True
    keys: tuple[str, ...] = field(default=())

    def structure_failures(self, df: DataFrame) -> list[str]:
        """Missing and unexpected columns; needs no job."""
        named = [r.name for r in self.rules]
        problems = [f"missing column {n}" for n in named if n not in df.columns]
        if self.strict:
            allowed = {*named, *self.keys}
            problems += [f"unexpected column {c}" for c in df.columns if c not in allowed]
        return problems

    def _present(self, df: DataFrame) -> list[ColumnRule]:
        return [r for r in self.rules if r.name in df.columns]

    def coerce(self, df: DataFrame) -> DataFrame:
        """Every ruled column in its declared type; cells that cannot be cast become NULL."""
        return df.withColumns(
            {r.name: cast_or_null(F.col(f"`{r.name}`"), r.type_name) for r in self._present(df)}
        )

    def failures(self, df: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
        """Long report (row_id, column, check, failure_case). Clean rows leave before the explode."""
        cells = []
        for rule in self._present(df):
            shown = F.col(f"`{rule.name}`").cast("string")
            for check, broken in rule.checks():
                cells.append(
                    F.when(
                        broken,
                        F.struct(
                            F.lit(rule.name).alias("column"),
                            F.lit(check).alias("check"),
                            shown.alias("failure_case"),
                        ),
                    )
                )
        if not cells:
            return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
        keys = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in id_cols]
        row_id = F.concat_ws("|", *keys) if keys else F.lit(None).cast("string")
        return (
            df.filter(self.broken(df))
            .select(row_id.alias("row_id"), F.inline(F.array_compact(F.array(*cells))))
        )

    def broken(self, df: DataFrame) -> Column:
        """True for rows that break at least one rule (never NULL)."""
        flags = [F.coalesce(b, F.lit(False)) for r in self._present(df) for _, b in r.checks()]
        return functools.reduce(operator.or_, flags, F.lit(False))

    def summary(self, df: DataFrame) -> DataFrame:
        """Violations per column and check, zeros included: one aggregation, then one row per rule."""
        named = [(r.name, c, b) for r in self._present(df) for c, b in r.checks()]
        counts = df.agg(*[F.count_if(b).alias(f"n{i}") for i, (_, _, b) in enumerate(named)])
        rows = F.array(
            *[
                F.struct(F.lit(n).alias("column"), F.lit(c).alias("check"), F.col(f"n{i}").alias("n_failures"))
                for i, (n, c, _) in enumerate(named)
            ]
        )
        return counts.select(F.inline(rows))

    def good_rows(self, df: DataFrame) -> DataFrame:
        return self.coerce(df.filter(~self.broken(df)))

    def bad_rows(self, df: DataFrame) -> DataFrame:
        return df.filter(self.broken(df))

    def validate(self, df: DataFrame) -> DataFrame:
        """The coerced table, or one error that names every structural and counted violation."""
        problems = self.structure_failures(df)
        named = self._present(df)
        if named:
            found = self.summary(df).filter("n_failures > 0").collect()
            problems += [f"{r['column']} breaks {r['check']} in {r['n_failures']} rows" for r in found]
        if problems:
            raise DataValidationError(f"contract broken: {'; '.join(problems)}", problems)
        return self.coerce(df)


# Fixed values of the housing tables: columns, limits and the category list.
OCEAN_PROXIMITY = ("<1H OCEAN", "INLAND", "NEAR OCEAN", "NEAR BAY", "ISLAND")

TRAINING = Contract(
    (
        ColumnRule("longitude", "double", nullable=False, at_least=-180.0, at_most=180.0),
        ColumnRule("latitude", "double", nullable=False, at_least=-90.0, at_most=90.0),
        ColumnRule("housing_median_age", "double", above=0.0),
        ColumnRule("total_rooms", "double", above=0.0),
        ColumnRule("total_bedrooms", "double", above=0.0),
        ColumnRule("population", "double", above=0.0),
        ColumnRule("households", "double", above=0.0),
        ColumnRule("median_income", "double", nullable=False, above=0.0),
        ColumnRule("median_house_value", "double", nullable=False, above=0.0),
        ColumnRule("ocean_proximity", "string", one_of=OCEAN_PROXIMITY),
    ),
    strict=True,
    keys=("district_id",),
)

# Records to be scored: numbers may be missing (the model fills them), the category may not;
# no limits; further columns are carried along.
INFERENCE = Contract(
    tuple(
        ColumnRule(name, "double")
        for name in (
            "longitude",
            "latitude",
            "housing_median_age",
            "total_rooms",
            "total_bedrooms",
            "population",
            "households",
            "median_income",
        )
    )
    + (ColumnRule("ocean_proximity", "string", nullable=False),),
    strict=False,
)
