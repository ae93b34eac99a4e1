"""Feature-set compositions (each is a handful of wide projections)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cabinlens import schema as S
from cabinlens.functions.exprs import cut as cut_expr
from cabinlens.operators import derive as D
from cabinlens.operators import encode as E
from cabinlens.operators import missing as M
from cabinlens.sources.io import normalize_columns

#: Arrival minus departure delay.
DELAY_GAP = ("Flight_Delay_Difference_Minutes", "Arrival_Delay_in_Minutes", "Departure_Delay_in_Minutes")


def on_off_features() -> list[str]:
    """Columns of the full set that the feature search switches one by one."""
    return [*S.SURVEY, "Gender_Male", "Type_of_Travel_Personal", "Class_Economy", "Class_Economy_Plus",
            *[f"{a}_x_{b}" for a, b in S.INTERACTIONS], *[n for n, _ in S.SCORE_SUMS], *[n for n, _, _ in S.CONSISTENCY_DIFFS]]


# -- D16 --------------------------------------------------------------------
def prepare_frame(raw: DataFrame, labelled: bool = True) -> DataFrame:
    """Normalise names, fill arrival delay from departure, encode the label."""
    df = M.fill_from(normalize_columns(raw))
    if labelled and S.TARGET in df.columns:
        df = E.encode_rating(df)
    return df


def prepare(train_raw: DataFrame, test_raw: DataFrame, strategy: str = "none") -> tuple[DataFrame, DataFrame]:
    train = M.fill_from(normalize_columns(train_raw))
    test = M.fill_from(normalize_columns(test_raw))
    train, test = M.handle_nonresponse(train, test, strategy)
    return E.encode_rating(train), test


# -- D13 --------------------------------------------------------------------
def add_bins(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "Age_bins": cut_expr("Age", *S.AGE_BINS),
            "Flight_Distance_bins": cut_expr("Flight_Distance", *S.DISTANCE_BINS),
            "Flight_Delay_Difference": cut_expr("Flight_Delay_Difference_Minutes", *S.DELAY_DIFF_BINS),
        }
    )


def features_full(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Full feature set: delay flag, totals, bins, squares, frequencies,
    one-hot, 13 products, three scores, four consistency gaps.  Category
    and frequency tables are fitted on ``fit_on`` (default: the frame itself,
    as the reference does)."""
    out = D.delay_flag(df)
    out = D.total(out, "Total_Delay_Minutes", "Departure_Delay_in_Minutes", "Arrival_Delay_in_Minutes")
    out = D.difference(out, [DELAY_GAP])
    out = add_bins(out)
    out = D.polynomial(out, S.POLY_COLUMNS)
    base = out if fit_on is None else features_prefix(fit_on)
    out = E.FrequencyEncoder.fit(base, S.FREQ_COLUMNS).transform(out)
    out = E.OneHot.fit(base, S.FULL_ONEHOT).transform(out)
    return D.difference(D.row_sum(D.multiply(out, S.INTERACTIONS), S.SCORE_SUMS), S.CONSISTENCY_DIFFS)


def features_prefix(df: DataFrame) -> DataFrame:
    """The part of ``features_full`` that precedes the fitted encoders."""
    out = D.difference(D.delay_flag(df), [DELAY_GAP])
    return add_bins(out)


# -- D14 --------------------------------------------------------------------
def features_tree(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Boosted-tree set: Age and Age^2, drop-first dummies, survey dummies."""
    out = D.polynomial(df, ["Age"])
    out = E.OneHot.fit(fit_on if fit_on is not None else df, S.CATEGORICAL, drop_first=True).transform(out)
    out = E.survey_dummies(out)
    return normalize_columns(out)


# -- D15 --------------------------------------------------------------------
def features_nn(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Network set: dummies, survey dummies, standard-scaled numbers."""
    base = fit_on if fit_on is not None else df
    out = E.OneHot.fit(base, S.CATEGORICAL, drop_first=True).transform(df)
    out = E.survey_dummies(out)
    out = normalize_columns(out)
    return D.StandardScale.fit(base, S.NUMERIC).transform(out)
