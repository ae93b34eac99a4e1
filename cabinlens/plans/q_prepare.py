"""Queries for sources, missing data, encodings and derived features."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.functions.exprs import c
from cabinlens.operators import derive as D
from cabinlens.operators import encode as E
from cabinlens.operators import missing as M
from cabinlens.operators import select as SEL
from cabinlens.plans import features as FE
from cabinlens.plans.catalog import all_frame, finish, register, test_frame, train_frame
from cabinlens.plans.oracle import base, cut_sql, q, r6
from cabinlens.sources import fixtures as FX
from cabinlens.sources.io import normalize_columns

SURVEY_Q = [q(x) for x in S.SURVEY]

# ---------------------------------------------------------------------------
# A2 + D16: prepared table


@register(
    "prepare_normalized",
    base() + "SELECT * FROM prep",
)
def prepare_normalized(spark, sf):
    return finish(all_frame(spark, sf))


@register(
    "fill_arrival_from_departure",
    base()
    + "SELECT id, \"Departure Delay in Minutes\" AS Departure_Delay_in_Minutes, "
    + r6("COALESCE(\"Arrival Delay in Minutes\", \"Departure Delay in Minutes\")")
    + " AS Arrival_Delay_in_Minutes FROM passengers",
)
def fill_arrival_from_departure(spark, sf):
    df = normalize_columns(FX.passengers(spark, sf))
    return finish(M.fill_from(df).select("id", "Departure_Delay_in_Minutes", "Arrival_Delay_in_Minutes"))


# ---------------------------------------------------------------------------
# B2 + C1: the notebook baseline preparation (train mode fills test)

_NB_CODES_SQL = ",\n".join(
    f"CASE {q(col)} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in m.items()) + f" END AS {q(col)}"
    for col, m in S.NOTEBOOK_CODES.items()
)


@register(
    "notebook_codes_mode_fill",
    base(
        "m AS (SELECT \"Arrival Delay in Minutes\" AS v FROM raw_train WHERE v IS NOT NULL"
        " GROUP BY v ORDER BY count(*) DESC, v ASC LIMIT 1)",
        "t AS (SELECT id, \"Gender\" AS Gender, \"Customer Type\" AS Customer_Type,"
        " \"Type of Travel\" AS Type_of_Travel, \"Class\" AS Class,"
        " COALESCE(\"Arrival Delay in Minutes\", (SELECT v FROM m)) AS arrival FROM raw_test)",
    )
    + f"SELECT id, {_NB_CODES_SQL}, {r6('arrival')} AS Arrival_Delay_in_Minutes FROM t",
)
def notebook_codes_mode_fill(spark, sf):
    train = normalize_columns(FX.raw_train(spark, sf))
    test = normalize_columns(FX.raw_test(spark, sf))
    filled = M.FillMode.fit(train, ["Arrival_Delay_in_Minutes"]).transform(test)
    for col, mapping in S.NOTEBOOK_CODES.items():
        filled = E.map_values(filled, col, mapping)
    return finish(filled.select("id", *S.NOTEBOOK_CODES, "Arrival_Delay_in_Minutes"))


# ---------------------------------------------------------------------------
# B3


@register(
    "null_counts",
    base(
        "n AS ("
        + "\nUNION ALL\n".join(
            f"SELECT {i} AS pos, '{x}' AS \"column\", CAST(count(*) - count({q(x)}) AS BIGINT) AS nulls FROM passengers"
            for i, x in enumerate(S.RAW_COLUMNS)
        )
        + ")"
    )
    + "SELECT \"column\", nulls, CAST(SUM(nulls) OVER () AS BIGINT) AS total_nulls FROM n",
)
def null_counts(spark, sf):
    return M.null_counts(FX.passengers(spark, sf))


# ---------------------------------------------------------------------------
# Statistic imputation fitted on train, applied to test


def _stat_sql(agg: str) -> str:
    stats = ", ".join(f"{agg.format(c=q(x))} AS s{i}" for i, x in enumerate(S.SURVEY))
    cols = ", ".join(
        f"{r6(f'CASE WHEN {q(x)} = 0 THEN (SELECT s{i} FROM st) ELSE {q(x)} END')} AS {q(x)}"
        for i, x in enumerate(S.SURVEY)
    )
    return base(f"st AS (SELECT {stats} FROM train)") + f"SELECT id, {cols} FROM test"


@register("impute_mean_train_to_test", _stat_sql("AVG({c})"))
def impute_mean(spark, sf):
    model = M.ImputeStat.fit(train_frame(spark, sf), S.SURVEY, "mean")
    return finish(model.transform(test_frame(spark, sf)).select("id", *[c(x) for x in S.SURVEY]))


@register("impute_median_train_to_test", _stat_sql("QUANTILE_CONT({c}, 0.5)"))
def impute_median(spark, sf):
    model = M.ImputeStat.fit(train_frame(spark, sf), S.SURVEY, "median")
    return finish(model.transform(test_frame(spark, sf)).select("id", *[c(x) for x in S.SURVEY]))


def _mode_sql_expr(x: str, source: str) -> str:
    return f"(SELECT {q(x)} FROM {source} WHERE {q(x)} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@register(
    "nonresponse_mode_strategy",
    base(
        "st AS (SELECT "
        + ", ".join(f"{_mode_sql_expr(x, 'train')} AS s{i}" for i, x in enumerate(S.SURVEY))
        + ")"
    )
    + "SELECT id, "
    + ", ".join(
        f"{r6(f'CASE WHEN {q(x)} = 0 THEN (SELECT s{i} FROM st) ELSE {q(x)} END')} AS {q(x)}"
        for i, x in enumerate(S.SURVEY)
    )
    + " FROM test",
)
def nonresponse_mode_strategy(spark, sf):
    _, test = M.handle_nonresponse(train_frame(spark, sf), test_frame(spark, sf), "mode")
    return finish(test.select("id", *[c(x) for x in S.SURVEY]))


# ---------------------------------------------------------------------------
# Sequential group-mean imputation (each frame on its own)


def _group_mean_sql(source: str) -> str:
    """One CTE per column step, in listed order."""
    ctes = []
    prev = f"g0"
    ctes.append(f"g0 AS (SELECT id, " + ", ".join(f"CAST({q(x)} AS DOUBLE) AS {q(x)}" for x in S.SURVEY)
                + f" FROM {source})")
    modes = ", ".join(f"{_mode_sql_expr(x, source)} AS m{i}" for i, x in enumerate(S.SURVEY))
    ctes.append(f"gm AS (SELECT {modes})")
    step = 0
    for feats in S.GROUPS.values():
        for x in feats:
            step += 1
            peers = [p for p in feats if p != x]
            total = " + ".join(f"COALESCE({q(p)}, 0)" for p in peers)
            count = " + ".join(f"CASE WHEN {q(p)} IS NULL THEN 0 ELSE 1 END" for p in peers)
            i = S.SURVEY.index(x)
            fill = (f"CASE WHEN {q(x)} = 0 THEN COALESCE(CASE WHEN ({count}) > 0 THEN ({total}) / ({count}) END,"
                    f" CAST((SELECT m{i} FROM gm) AS DOUBLE)) ELSE {q(x)} END")
            ctes.append(f"g{step} AS (SELECT * REPLACE ({fill} AS {q(x)}) FROM {prev})")
            prev = f"g{step}"
    cols = ", ".join(f"{r6(q(x))} AS {q(x)}" for x in S.SURVEY)
    return base(*ctes) + f"SELECT id, {cols} FROM {prev}"


@register("group_mean_nonresponse", _group_mean_sql("train"))
def group_mean_nonresponse(spark, sf):
    out = M.impute_group_mean(train_frame(spark, sf))
    return finish(out.select("id", *[c(x) for x in S.SURVEY]))


@register("nonresponse_group_strategy", _group_mean_sql("test"))
def nonresponse_group_strategy(spark, sf):
    """B7's dispatch to the group means, each frame by its own modes."""
    _, test = M.handle_nonresponse(train_frame(spark, sf), test_frame(spark, sf), "group")
    return finish(test.select("id", *[c(x) for x in S.SURVEY]))


# ---------------------------------------------------------------------------
# Category codes (sorted position + 1)


@register(
    "category_codes",
    base(
        "b AS (SELECT id, Gender, Customer_Type, Type_of_Travel, Class, "
        + cut_sql("Age", *S.AGE_BINS)
        + " AS Age_bins FROM train)"
    )
    + "SELECT id, "
    + ", ".join(
        f"CAST(CASE WHEN {x} IS NULL THEN 0 ELSE DENSE_RANK() OVER (ORDER BY {x}) END AS INTEGER) AS {x}"
        for x in ["Gender", "Customer_Type", "Type_of_Travel", "Class", "Age_bins"]
    )
    + " FROM b",
)
def category_codes(spark, sf):
    from cabinlens.functions.exprs import cut

    df = train_frame(spark, sf).withColumn("Age_bins", cut(c("Age"), *S.AGE_BINS))
    cols = ["Gender", "Customer_Type", "Type_of_Travel", "Class", "Age_bins"]
    return E.CategoryCodes.fit(df, cols).transform(df).select("id", *cols)


# ---------------------------------------------------------------------------
# Label encoder fitted on train, applied to test


@register(
    "label_encode_class",
    base("cats AS (SELECT Class, CAST(ROW_NUMBER() OVER (ORDER BY Class) - 1 AS INTEGER) AS code"
         " FROM (SELECT DISTINCT Class FROM train))")
    + "SELECT test.id, cats.code AS Class FROM test JOIN cats USING (Class)",
)
def label_encode_class(spark, sf):
    model = E.label_encoder(train_frame(spark, sf), "Class")
    out = model.transform(test_frame(spark, sf).select("id", "Class"))
    return out.select("id", F.col("Class_idx").cast("int").alias("Class"))


# ---------------------------------------------------------------------------
# C4 / C5 / C6 / C7


def _onehot_sql(col: str, cats: list[str], keep_first: bool) -> str:
    kept = cats if keep_first else cats[1:]
    return ", ".join(
        f"CAST(COALESCE({col} = '{v}', false) AS INTEGER) AS {q((col + '_' + v).replace(' ', '_'))}" for v in kept
    )


_CATS = {
    "Gender": ["Female", "Male"],
    "Customer_Type": ["Loyal Customer", "Non-Loyal Customer"],
    "Type_of_Travel": ["Business", "Personal"],
    "Class": ["Business", "Economy", "Economy Plus"],
}
_BIN_CATS = {
    "Age_bins": sorted(S.AGE_BINS[1]),
    "Flight_Distance_bins": sorted(S.DISTANCE_BINS[1]),
    "Flight_Delay_Difference": sorted(S.DELAY_DIFF_BINS[1]),
}

_BINS_CTE = (
    "b AS (SELECT *, "
    + cut_sql("Age", *S.AGE_BINS) + " AS Age_bins, "
    + cut_sql("Flight_Distance", *S.DISTANCE_BINS) + " AS Flight_Distance_bins, "
    + cut_sql("Arrival_Delay_in_Minutes - Departure_Delay_in_Minutes", *S.DELAY_DIFF_BINS)
    + " AS Flight_Delay_Difference FROM train)"
)


@register(
    "onehot_full",
    base(_BINS_CTE)
    + "SELECT id, "
    + ", ".join(_onehot_sql(x, v, len(v) != 2) for x, v in {**_CATS, **_BIN_CATS}.items())
    + " FROM b",
)
def onehot_full(spark, sf):
    df = FE.features_prefix(train_frame(spark, sf))
    return E.onehot(df.select("id", *S.FULL_ONEHOT), S.FULL_ONEHOT)


@register(
    "dummies_train_fit",
    base() + "SELECT id, " + ", ".join(_onehot_sql(x, v, False) for x, v in _CATS.items()) + " FROM test",
)
def dummies_train_fit(spark, sf):
    test = test_frame(spark, sf).select("id", *S.CATEGORICAL)
    return E.dummies(test, S.CATEGORICAL, fit_on=train_frame(spark, sf))


@register(
    "survey_dummies",
    base()
    + "SELECT id, "
    + ", ".join(
        f"CAST(COALESCE({q(x)} = {v}, false) AS INTEGER) AS {q(f'{x}_{v}')}" for x in S.SURVEY for v in range(1, 6)
    )
    + " FROM train",
)
def survey_dummies(spark, sf):
    return E.survey_dummies(train_frame(spark, sf).select("id", *[c(x) for x in S.SURVEY]))


_FREQ_SQL = ", ".join(
    f"{r6(f'COUNT(*) OVER (PARTITION BY {x}) / COUNT({x}) OVER ()')} AS {x}_freq" for x in S.FREQ_COLUMNS
)


@register("frequency_encode", base() + f"SELECT id, {_FREQ_SQL} FROM train")
def frequency_encode(spark, sf):
    df = train_frame(spark, sf)
    out = E.frequency_encode(df.select("id", *S.FREQ_COLUMNS), S.FREQ_COLUMNS)
    return finish(out.select("id", *[f"{x}_freq" for x in S.FREQ_COLUMNS]))


# ---------------------------------------------------------------------------
# Numeric analysis transforms (fit on train, apply to test)


@register(
    "scale_age_train_to_test",
    base("st AS (SELECT AVG(Age) AS m, STDDEV_POP(Age) AS s FROM train)")
    + "SELECT id, " + r6("(Age - (SELECT m FROM st)) / CASE WHEN (SELECT s FROM st) = 0 THEN 1 ELSE (SELECT s FROM st) END")
    + " AS Age FROM test",
)
def scale_age_train_to_test(spark, sf):
    model = D.StandardScale.fit(train_frame(spark, sf), ["Age"])
    return finish(model.transform(test_frame(spark, sf)).select("id", "Age"))


@register(
    "log_sqrt_transforms",
    base()
    + "SELECT id, "
    + r6("LN(1 + Departure_Delay_in_Minutes)") + " AS Departure_Delay_in_Minutes, "
    + r6("LN(1 + Arrival_Delay_in_Minutes)") + " AS Arrival_Delay_in_Minutes, "
    + r6("SQRT(Flight_Distance)") + " AS Flight_Distance_sqrt, "
    + r6("LN(1 + Flight_Distance)") + " AS Flight_Distance_log FROM test",
)
def log_sqrt_transforms(spark, sf):
    df = test_frame(spark, sf)
    df = D.log1p(df, ["Departure_Delay_in_Minutes", "Arrival_Delay_in_Minutes"])
    df = D.sqrt(df, "Flight_Distance", "Flight_Distance_sqrt")
    df = df.withColumn("Flight_Distance_log", F.log1p("Flight_Distance"))
    return finish(df.select("id", "Departure_Delay_in_Minutes", "Arrival_Delay_in_Minutes",
                            "Flight_Distance_sqrt", "Flight_Distance_log"))


@register(
    "polynomial_features",
    base()
    + "SELECT id, "
    + ", ".join(
        f"CAST({x} AS DOUBLE) AS {x}, {r6(f'CAST({x} AS DOUBLE) * {x}')} AS {q(x + '^2')}"
        for x in S.POLY_COLUMNS
    )
    + f", {r6('CAST(Age AS DOUBLE) * Age * Age')} AS {q('Age^3')} FROM train",
)
def polynomial_features(spark, sf):
    df = D.polynomial(train_frame(spark, sf), [x for x in S.POLY_COLUMNS if x != "Age"])
    df = D.polynomial(df, ["Age"], degree=3)
    cols = [y for x in S.POLY_COLUMNS for y in (x, f"{x}^2")] + ["Age^3"]
    return finish(df.select("id", *[c(x) for x in cols]))


@register(
    "feature_bins",
    base(_BINS_CTE) + "SELECT id, Age_bins, Flight_Distance_bins, Flight_Delay_Difference FROM b",
)
def feature_bins(spark, sf):
    return FE.features_prefix(train_frame(spark, sf)).select(
        "id", "Age_bins", "Flight_Distance_bins", "Flight_Delay_Difference"
    )


def _qcut_label_sql(col: str) -> str:
    """Quartile intervals of ``col`` over raw_train, labelled like pandas.qcut
    (3 decimals; every edge here has a non-zero whole part)."""
    return (
        "qe AS (SELECT quantile_cont(CAST(\"Flight Distance\" AS DOUBLE), [0, 0.25, 0.5, 0.75, 1]) AS e FROM raw_train),"
        " ql AS (SELECT e, [ROUND(e[1], 3), ROUND(e[2], 3), ROUND(e[3], 3), ROUND(e[4], 3), ROUND(e[5], 3)] AS r FROM qe)"
    )


def _qcut_case(col: str) -> str:
    def shown(i):
        # repr-like text of a rounded double
        return f"CAST((SELECT r[{i}] FROM ql){' - 0.001' if i == 1 else ''} AS VARCHAR)"

    whens = []
    for i in range(1, 5):
        lo = f"(SELECT e[{i}] FROM ql)"
        hi = f"(SELECT e[{i + 1}] FROM ql)"
        cond = f"{col} >= {lo} AND {col} <= {hi}" if i == 1 else f"{col} > {lo} AND {col} <= {hi}"
        whens.append(f"WHEN {cond} THEN '(' || {shown(i)} || ', ' || {shown(i + 1)} || ']'")
    return "CASE " + " ".join(whens) + " END"


@register(
    "qcut_flight_distance",
    base(_qcut_label_sql("Flight Distance"))
    + f"SELECT id, {_qcut_case(q('Flight Distance'))} AS distance_quartile FROM raw_train",
)
def qcut_flight_distance(spark, sf):
    train = FX.raw_train(spark, sf)
    model = D.QuantileBins.fit(train, ["Flight Distance"])
    return train.select("id", model.expr("Flight Distance").alias("distance_quartile"))


@register(
    "interaction_strings",
    base(_qcut_label_sql("Flight Distance"),
         f"t AS (SELECT *, {_qcut_case(q('Flight Distance'))} AS qd FROM raw_train)")
    + "SELECT id, "
    + "\"Class\" || '_' || CAST(\"Seat Comfort\" AS VARCHAR) AS Class_SeatComfort, "
    + "\"Type of Travel\" || '_' || qd AS TravelType_FlightDistance, "
    + "CAST(\"Ease of Online booking\" AS VARCHAR) || '_' || CAST(\"Online Boarding\" AS VARCHAR)"
    + " AS OnlineBooking_OnlineBoarding, "
    + "qd || '_' || CAST(\"Seat Comfort\" AS VARCHAR) AS FlightDistance_SeatComfort, "
    + "CAST(\"Inflight Wifi Service\" AS VARCHAR) || '_' || qd AS InflightWifi_FlightDistance FROM t",
)
def interaction_strings(spark, sf):
    from cabinlens.plans.analysis import interaction_features

    return interaction_features(FX.raw_train(spark, sf)).select(
        "id", "Class_SeatComfort", "TravelType_FlightDistance", "OnlineBooking_OnlineBoarding",
        "FlightDistance_SeatComfort", "InflightWifi_FlightDistance",
    )


# ---------------------------------------------------------------------------
# The full feature set


def _full_sql(source: str = "train") -> tuple[str, list[str]]:
    """SQL of the full feature set over ``source`` and its double columns."""
    inter_cols = []
    dbl = {"Total_Delay_Minutes", "Flight_Delay_Difference_Minutes", "Arrival_Delay_in_Minutes",
           "Flight_Distance", "Age", "Departure_Delay_in_Minutes"}
    dbl |= {f"{x}^2" for x in S.POLY_COLUMNS} | {f"{x}_freq" for x in S.FREQ_COLUMNS}
    for a, b in S.INTERACTIONS:
        name = f"{a}_x_{b}"
        inter_cols.append(f"{q(a)} * {q(b)} AS {q(name)}")
        if a in dbl or b in dbl:
            dbl.add(name)
    f1 = (
        f"f1 AS (SELECT *, "
        "CAST(COALESCE(Arrival_Delay_in_Minutes > 0, false) OR COALESCE(Departure_Delay_in_Minutes > 0, false)"
        " AS INTEGER) AS Experienced_Delay, "
        "Departure_Delay_in_Minutes + Arrival_Delay_in_Minutes AS Total_Delay_Minutes, "
        "Arrival_Delay_in_Minutes - Departure_Delay_in_Minutes AS Flight_Delay_Difference_Minutes, "
        + cut_sql("Age", *S.AGE_BINS) + " AS Age_bins, "
        + cut_sql("Flight_Distance", *S.DISTANCE_BINS) + " AS Flight_Distance_bins, "
        + cut_sql("Arrival_Delay_in_Minutes - Departure_Delay_in_Minutes", *S.DELAY_DIFF_BINS)
        + f" AS Flight_Delay_Difference FROM {source})"
    )
    poly = ", ".join(
        f"CAST({x} AS DOUBLE) * {x} AS {q(x + '^2')}" for x in S.POLY_COLUMNS
    )
    f2 = (
        "f2 AS (SELECT * EXCLUDE (Gender, Customer_Type, Type_of_Travel, Class, Age_bins, Flight_Distance_bins,"
        " Flight_Delay_Difference) REPLACE (CAST(Flight_Distance AS DOUBLE) AS Flight_Distance,"
        " CAST(Age AS DOUBLE) AS Age, CAST(Departure_Delay_in_Minutes AS DOUBLE) AS Departure_Delay_in_Minutes), "
        + poly + ", "
        + ", ".join(f"CASE WHEN {x} IS NOT NULL THEN COUNT(*) OVER (PARTITION BY {x}) / COUNT({x}) OVER () END"
                    f" AS {x}_freq" for x in S.FREQ_COLUMNS)
        + ", "
        + ", ".join(_onehot_sql(x, v, len(v) != 2) for x, v in {**_CATS, **_BIN_CATS}.items())
        + " FROM f1)"
    )
    scores = ", ".join(
        "(" + " + ".join(f"COALESCE({q(x)}, 0)" for x in cols) + f") AS {name}" for name, cols in S.SCORE_SUMS
    )
    diffs = ", ".join(f"{q(a)} - {q(b)} AS {name}" for name, a, b in S.CONSISTENCY_DIFFS)
    f3 = f"f3 AS (SELECT *, {', '.join(inter_cols)}, {scores}, {diffs} FROM f2)"
    return ",\n".join([f1, f2, f3]), sorted(dbl)


_FULL_CTES, _FULL_DOUBLES = _full_sql()
# columns of the full feature set (names only, used to pick SQL exclusions)
_FULL_COLUMNS = set(_FULL_DOUBLES) | set(S.SURVEY) | {
    "Experienced_Delay", "Gender_Male", "Customer_Type_Non-Loyal_Customer", "Type_of_Travel_Personal",
    "Class_Business", "Class_Economy", "Class_Economy_Plus", *[f"{a}_x_{b}" for a, b in S.INTERACTIONS],
    *[n for n, _ in S.SCORE_SUMS], *[n for n, _, _ in S.CONSISTENCY_DIFFS],
}


def _full_select(exclude=()) -> str:
    ex = f"EXCLUDE ({', '.join(q(x) for x in exclude)}) " if exclude else ""
    rounded = ", ".join(f"{r6(q(x))} AS {q(x)}" for x in _FULL_DOUBLES if x not in exclude)
    return f"SELECT * {ex}REPLACE ({rounded}) FROM f3"


_FULL_ROUNDED = _full_select()


@register("features_full", base(_FULL_CTES) + _FULL_ROUNDED)
def features_full(spark, sf):
    return finish(FE.features_full(train_frame(spark, sf)))


def _full_subset(cols):
    def run(spark, sf):
        return finish(FE.features_full(train_frame(spark, sf)).select("id", *[c(x) for x in cols]))

    return run


def _subset_sql(cols):
    sel = ", ".join(f"{r6(q(x))} AS {q(x)}" if x in _FULL_DOUBLES else q(x) for x in cols)
    return base(_FULL_CTES) + f"SELECT id, {sel} FROM f3"


_PRODUCTS = [f"{a}_x_{b}" for a, b in S.INTERACTIONS]
_SCORES = [name for name, _ in S.SCORE_SUMS]
_GAPS = ["Total_Delay_Minutes", "Flight_Delay_Difference_Minutes", *[n for n, _, _ in S.CONSISTENCY_DIFFS]]

register("interaction_products", _subset_sql(_PRODUCTS))(_full_subset(_PRODUCTS))
register("aggregate_scores", _subset_sql(_SCORES))(_full_subset(_SCORES))
register("delay_and_feedback_gaps", _subset_sql(_GAPS))(_full_subset(_GAPS))
register("experienced_delay", _subset_sql(["Experienced_Delay"]))(_full_subset(["Experienced_Delay"]))

# A fixed search configuration expanded into a projection
SAMPLE_SELECTION = {
    "Age_Selection": "squared",
    "Flight_Distance_Selection": "bins",
    "Delay_Selection": "total",
    "Delay_Difference_Selection": "bins",
    **{x: (i % 2 == 0) for i, x in enumerate(S.SURVEY)},
    "Type_of_Travel_Personal": True,
    "Class_Economy": True,
    "Seat_Comfort_x_Leg_Room": True,
    "Comfort_Score": True,
    "diff_wifi_onlineboarding": True,
}
_SEL_COLS = D.expand_selection(SAMPLE_SELECTION)
register("expand_selection", _subset_sql(_SEL_COLS))(_full_subset(_SEL_COLS))

# E1 / E2
_BEST_PRESENT = [x for x in S.BEST_FEATURES]


@register(
    "keep_best_features",
    base(_FULL_CTES)
    + "SELECT id, Satisfaction_Rating, "
    + ", ".join(f"{r6(q(x))} AS {q(x)}" if x in _FULL_DOUBLES else q(x) for x in _BEST_PRESENT)
    + " FROM f3",
)
def keep_best_features(spark, sf):
    return finish(SEL.keep_features(FE.features_full(train_frame(spark, sf)), S.BEST_FEATURES))


@register(
    "drop_low_importance",
    base(_FULL_CTES) + _full_select([x for x in S.LOW_IMPORTANCE if x in _FULL_COLUMNS]),
)
def drop_low_importance(spark, sf):
    return finish(SEL.drop_features(FE.features_full(train_frame(spark, sf)), S.LOW_IMPORTANCE))


# ---------------------------------------------------------------------------
# D14 / D15


_TREE_SQL = (
    base()
    + "SELECT * EXCLUDE (Gender, Customer_Type, Type_of_Travel, Class, "
    + ", ".join(SURVEY_Q)
    + ") REPLACE (CAST(Age AS DOUBLE) AS Age), CAST(Age AS DOUBLE) * Age AS \"Age^2\", "
    + ", ".join(_onehot_sql(x, v, False) for x, v in _CATS.items())
    + ", "
    + ", ".join(
        f"CAST(COALESCE({q(x)} = {v}, false) AS INTEGER) AS {q(f'{x}_{v}')}" for x in S.SURVEY for v in range(1, 6)
    )
    + " FROM train"
)


@register("features_tree", "SELECT * REPLACE (ROUND(Arrival_Delay_in_Minutes, 6) AS Arrival_Delay_in_Minutes) FROM ("
          + _TREE_SQL + ")")
def features_tree(spark, sf):
    return finish(FE.features_tree(train_frame(spark, sf)))


_NN_SQL = (
    base(
        "st AS (SELECT " + ", ".join(f"AVG({x}) AS m_{x}, STDDEV_POP({x}) AS s_{x}" for x in S.NUMERIC) + " FROM train)"
    )
    + "SELECT * EXCLUDE (Gender, Customer_Type, Type_of_Travel, Class, "
    + ", ".join(SURVEY_Q)
    + ") REPLACE ("
    + ", ".join(
        r6(f"({x} - (SELECT m_{x} FROM st)) / CASE WHEN (SELECT s_{x} FROM st) = 0 THEN 1 ELSE (SELECT s_{x} FROM st) END")
        + f" AS {x}"
        for x in S.NUMERIC
    )
    + "), "
    + ", ".join(_onehot_sql(x, v, False) for x, v in _CATS.items())
    + ", "
    + ", ".join(
        f"CAST(COALESCE({q(x)} = {v}, false) AS INTEGER) AS {q(f'{x}_{v}')}" for x in S.SURVEY for v in range(1, 6)
    )
    + " FROM train"
)


@register("features_nn", _NN_SQL)
def features_nn(spark, sf):
    return finish(FE.features_nn(train_frame(spark, sf)))


# ---------------------------------------------------------------------------
# Exact KNN imputation fitted on train, applied to test.  The oracle compares
# every receiver pattern with every donor.


def _knn_sql(k: int = 5) -> str:
    cols, n = list(S.SURVEY), len(S.SURVEY)

    def present(x: str) -> str:
        return f"r.{q(x)} <> 0 AND t.{q(x)} <> 0"

    answers = ", ".join(f"COALESCE({q(x)}, 0) AS {q(x)}" for x in cols)
    total = " + ".join(f"CASE WHEN {present(x)} THEN (r.{q(x)} - t.{q(x)}) ** 2 ELSE 0 END" for x in cols)
    shared = " + ".join(f"CAST({present(x)} AS INTEGER)" for x in cols)
    both = ", ".join(f"r.{q(x)} AS r{i}, t.{q(x)} AS t{i}" for i, x in enumerate(cols))
    near = ", ".join(f"min({{'d': d, 'id': id, 'v': t{i}}}, {k}) FILTER (WHERE r{i} = 0 AND t{i} <> 0) AS m{i}" for i in range(n))
    own = ", ".join(f"r{i}" for i in range(n))
    means = ", ".join(f"AVG(NULLIF({q(x)}, 0)) AS a{i}" for i, x in enumerate(cols))
    out = ", ".join(
        r6(f"CASE WHEN p.{q(x)} <> 0 THEN p.{q(x)} ELSE COALESCE(list_avg(list_transform(m{i}, lambda s: s.v)), a{i}) END") + f" AS {q(x)}"
        for i, x in enumerate(cols))
    return base(
        f"people AS (SELECT id, {answers} FROM test)",
        f"donors AS (SELECT id, {answers} FROM train)",
        f"r AS (SELECT DISTINCT {', '.join(map(q, cols))} FROM people WHERE {' OR '.join(f'{q(x)} = 0' for x in cols)})",
        f"pairs AS (SELECT t.id, {both}, {total} AS total, {shared} AS shared FROM r, donors t)",
        f"near AS (SELECT {own}, {near} FROM (SELECT *, total * (CAST({n} AS DOUBLE) / shared) AS d FROM pairs WHERE shared > 0) GROUP BY ALL)",
        f"means AS (SELECT {means} FROM donors)",
    ) + f"SELECT p.id, {out} FROM people p CROSS JOIN means LEFT JOIN near ON " + " AND ".join(f"p.{q(x)} = r{i}" for i, x in enumerate(cols))


@register("knn_nonresponse", _knn_sql())
def knn_nonresponse(spark, sf):
    from cabinlens.operators.knn import KnnImputer

    model = KnnImputer.fit(train_frame(spark, sf), S.SURVEY, k=5)
    return finish(model.transform(test_frame(spark, sf)).select("id", *[c(x) for x in S.SURVEY]))


# ---------------------------------------------------------------------------
# A1 + A3: the train file as the reference receives it (headered CSV with
# blanks for missing delays), written from the given table and read back
# with the explicit schema.


@register(
    "csv_roundtrip_train",
    base() + "SELECT * REPLACE (" + r6("Arrival_Delay_in_Minutes") + " AS Arrival_Delay_in_Minutes)"
    " FROM (SELECT * FROM norm WHERE id % 4 <> 0)",
)
def csv_roundtrip_train(spark, sf):
    import uuid

    from cabinlens.session import scratch_path
    from cabinlens.sources import io as IO

    path = scratch_path(spark, f"train-csv-{uuid.uuid4().hex}")
    IO.write_table(FX.raw_train(spark, sf), path)
    return finish(IO.normalize_columns(IO.read_survey(spark, path, IO.survey_schema())))


# Network input with columns in alphabetical order (id and label kept)


@register("split_xy_sorted", _NN_SQL)
def split_xy_sorted(spark, sf):
    out, cols = SEL.split_xy(FE.features_nn(train_frame(spark, sf)), sort=True, vector=False)
    assert cols == sorted(cols)
    return finish(out)


# a value map as a table, looked up by key (size-checked broadcast join)


@register(
    "class_share_lookup",
    base("sh AS (SELECT Class, count(*) / (SELECT count(Class) FROM train) AS share FROM train"
         " WHERE Class IS NOT NULL GROUP BY 1)")
    + f"SELECT test.id, test.Class, {r6('sh.share')} AS class_share FROM test LEFT JOIN sh USING (Class)",
)
def class_share_lookup(spark, sf):
    from cabinlens.operators import profile as P

    shares = P.value_counts(train_frame(spark, sf), "Class", normalize=True).select(
        F.col("value").alias("Class"), F.col("share").alias("class_share"))
    return finish(E.lookup(test_frame(spark, sf).select("id", "Class"), shares, "Class"))
