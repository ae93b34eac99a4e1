"""Queries for profiles, drift tables and plot data."""

from __future__ import annotations

from cabinlens import schema as S
from cabinlens.plans import analysis as AN
from cabinlens.plans.catalog import register
from cabinlens.plans.oracle import base, cut_sql, q
from cabinlens.sources import fixtures as FX

_GROUPS_CTE = (
    "g AS (SELECT \"Satisfaction Rating\", "
    + cut_sql("Age", *S.AGE_GROUP_BINS, right=False) + " AS ag, "
    + cut_sql(q("Departure Delay in Minutes"), *S.DELAY_GROUP_BINS, right=False) + " AS dg, "
    + cut_sql(q("Arrival Delay in Minutes"), *S.DELAY_GROUP_BINS, right=False) + " AS rg FROM raw_train)"
)


@register(
    "label_counts_by_group",
    base(_GROUPS_CTE)
    + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS feature, {col} AS value, \"Satisfaction Rating\", count(*) AS count"
        f" FROM g WHERE {col} IS NOT NULL GROUP BY ALL"
        for name, col in (("Age Group", "ag"), ("Departure Delay Group", "dg"), ("Arrival Delay Group", "rg"))
    ),
)
def label_counts_by_group(spark, sf):
    return AN.label_counts(AN.group_features(FX.raw_train(spark, sf)))


# ---------------------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from cabinlens.functions.exprs import c  # noqa: E402
from cabinlens.operators import derive as D  # noqa: E402
from cabinlens.operators import profile as P  # noqa: E402
from cabinlens.plans import features as FE  # noqa: E402
from cabinlens.plans.catalog import finish, test_frame, train_frame  # noqa: E402
from cabinlens.plans.oracle import r6  # noqa: E402

_SPARK_TYPE = ("CASE any_value(typeof({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'"
               " WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' END")


@register(
    "table_info",
    base()
    + "\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{x}' AS \"column\", {_SPARK_TYPE.format(c=q(x))} AS type,"
        f" count({q(x)}) AS non_null FROM passengers"
        for i, x in enumerate(S.RAW_COLUMNS)
    ),
)
def table_info(spark, sf):
    return P.table_info(FX.passengers(spark, sf))


_NUM_RAW = [x for x in S.RAW_COLUMNS if x not in ("Gender", "Customer Type", "Type of Travel", "Class",
                                                   "Satisfaction Rating")]


@register(
    "describe_numeric",
    base()
    + "\nUNION ALL\n".join(
        f"SELECT '{x}' AS \"column\", count({q(x)}) AS count, {r6(f'avg({q(x)})')} AS mean,"
        f" {r6(f'stddev_samp({q(x)})')} AS std, {r6(f'min({q(x)})')} AS min,"
        f" {r6(f'quantile_cont({q(x)}, 0.25)')} AS q25, {r6(f'quantile_cont({q(x)}, 0.5)')} AS q50,"
        f" {r6(f'quantile_cont({q(x)}, 0.75)')} AS q75, {r6(f'max({q(x)})')} AS max FROM raw_train"
        for x in _NUM_RAW
    ),
)
def describe_numeric(spark, sf):
    return finish(P.describe(FX.raw_train(spark, sf), _NUM_RAW))


@register(
    "rating_value_counts",
    base() + "SELECT \"Satisfaction Rating\" AS value, count(*) AS count FROM raw_train"
    " WHERE value IS NOT NULL GROUP BY 1",
)
def rating_value_counts(spark, sf):
    return P.value_counts(FX.raw_train(spark, sf), S.RAW_TARGET)


@register(
    "class_value_shares",
    base() + f"SELECT Class AS value, {r6('count(*) / (SELECT count(Class) FROM train)')} AS share"
    " FROM train WHERE Class IS NOT NULL GROUP BY 1",
)
def class_value_shares(spark, sf):
    return finish(P.value_counts(train_frame(spark, sf), "Class", normalize=True))


@register(
    "survey_answer_counts",
    base()
    + "\nUNION ALL\n".join(
        f"SELECT '{x}' AS \"column\", {q(x)} AS value, count(*) AS count FROM raw_train"
        f" WHERE {q(x)} IS NOT NULL GROUP BY 2"
        for x in S.RAW_SURVEY_COLUMNS
    ),
)
def survey_answer_counts(spark, sf):
    counts, _ = P.survey_report(FX.raw_train(spark, sf), S.RAW_SURVEY_COLUMNS)
    return counts


@register(
    "survey_answer_stats",
    base()
    + "\nUNION ALL\n".join(
        f"SELECT '{x}' AS \"column\", {r6(f'ROUND(avg({q(x)}), 2)')} AS mean,"
        f" {r6(f'quantile_cont({q(x)}, 0.5)')} AS median,"
        f" (SELECT {q(x)} FROM raw_train WHERE {q(x)} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
        f" AS mode FROM raw_train"
        for x in S.RAW_SURVEY_COLUMNS
    ),
)
def survey_answer_stats(spark, sf):
    _, stats = P.survey_report(FX.raw_train(spark, sf), S.RAW_SURVEY_COLUMNS)
    return finish(stats)


_PROFILE_COLS = ["Age", "Flight Distance", "Departure Delay in Minutes", "Arrival Delay in Minutes",
                 "Flight Distance_sqrt", "Flight Distance_log"]


def _transformed_train(spark, sf):
    train = FX.raw_train(spark, sf)
    train = D.StandardScale.fit(train, ["Age"]).transform(train)
    train = D.log1p(train, ["Departure Delay in Minutes", "Arrival Delay in Minutes"])
    train = D.sqrt(train, "Flight Distance", "Flight Distance_sqrt")
    return train.withColumn("Flight Distance_log", F.log1p(c("Flight Distance")))


_TRANSFORMED_SQL = (
    "st AS (SELECT avg(Age) AS m, stddev_pop(Age) AS s FROM raw_train), "
    "tt AS (SELECT (Age - (SELECT m FROM st)) / (SELECT s FROM st) AS \"Age\", "
    "CAST(\"Flight Distance\" AS DOUBLE) AS \"Flight Distance\", "
    "LN(1 + \"Departure Delay in Minutes\") AS \"Departure Delay in Minutes\", "
    "LN(1 + \"Arrival Delay in Minutes\") AS \"Arrival Delay in Minutes\", "
    "SQRT(\"Flight Distance\") AS \"Flight Distance_sqrt\", LN(1 + \"Flight Distance\") AS \"Flight Distance_log\""
    " FROM raw_train)"
)


@register(
    "numeric_profile",
    base(_TRANSFORMED_SQL)
    + "\nUNION ALL\n".join(
        f"SELECT '{x}' AS \"column\", {r6(f'avg({q(x)})')} AS mean, {r6(f'quantile_cont({q(x)}, 0.5)')} AS median,"
        f" {r6(f'stddev_samp({q(x)})')} AS std, {r6(f'min({q(x)})')} AS min, {r6(f'max({q(x)})')} AS max,"
        f" {r6(f'quantile_cont({q(x)}, 0.25)')} AS q25, {r6(f'quantile_cont({q(x)}, 0.75)')} AS q75,"
        f" {r6(f'quantile_cont({q(x)}, 0.75) - quantile_cont({q(x)}, 0.25)')} AS iqr,"
        f" {r6(f'skewness({q(x)})')} AS skewness, {r6(f'kurtosis({q(x)})')} AS kurtosis FROM tt"
        for x in _PROFILE_COLS
    ),
)
def numeric_profile(spark, sf):
    return finish(P.numeric_profile(_transformed_train(spark, sf), _PROFILE_COLS))


# train/test drift on the tree feature set (the saved full feature files)
def _tree_pair(spark, sf):
    train = FE.features_tree(train_frame(spark, sf)).drop(S.TARGET)
    test = FE.features_tree(test_frame(spark, sf), fit_on=train_frame(spark, sf))
    return train, test


_TREE_NUMERIC = ["id", "Age", "Flight_Distance", "Departure_Delay_in_Minutes", "Arrival_Delay_in_Minutes", "Age^2"]
_TREE_DUMMIES = ["Gender_Male", "Customer_Type_Non-Loyal_Customer", "Type_of_Travel_Personal", "Class_Economy",
                 "Class_Economy_Plus"]
_TREE_COLS = _TREE_NUMERIC + _TREE_DUMMIES + [f"{x}_{v}" for x in S.SURVEY for v in range(1, 6)]


def _tree_sql(source: str) -> str:
    return (
        f"SELECT id, CAST(Age AS DOUBLE) AS Age, CAST(Flight_Distance AS DOUBLE) AS Flight_Distance,"
        f" CAST(Departure_Delay_in_Minutes AS DOUBLE) AS Departure_Delay_in_Minutes, Arrival_Delay_in_Minutes,"
        f" CAST(Age AS DOUBLE) * Age AS \"Age^2\", "
        + ", ".join(
            f"CAST({a} = '{v}' AS DOUBLE) AS {q(n)}"
            for a, v, n in (("Gender", "Male", "Gender_Male"), ("Customer_Type", "Non-Loyal Customer",
                            "Customer_Type_Non-Loyal_Customer"), ("Type_of_Travel", "Personal",
                            "Type_of_Travel_Personal"), ("Class", "Economy", "Class_Economy"),
                            ("Class", "Economy Plus", "Class_Economy_Plus"))
        )
        + ", "
        + ", ".join(f"CAST({q(x)} = {v} AS DOUBLE) AS {q(f'{x}_{v}')}" for x in S.SURVEY for v in range(1, 6))
        + f" FROM {source}"
    )


_TREE_CTES = (f"tr AS ({_tree_sql('train')}), te AS ({_tree_sql('test')})",)


def _moment_sql(src: str, tag: str, x: str) -> str:
    n = f"count({q(x)})"
    has_null = f"count(*) <> count({q(x)})"
    return (
        f"{r6(f'avg({q(x)})')} AS {tag}_mean, {r6(f'stddev_samp({q(x)})')} AS {tag}_std, "
        f"{r6(f'CASE WHEN {has_null} THEN NULL ELSE skewness({q(x)}) * ({n} - 2) / SQRT({n} * ({n} - 1)) END')}"
        f" AS {tag}_skew, "
        f"{r6(f'CASE WHEN {has_null} THEN NULL ELSE kurtosis_pop({q(x)}) END')} AS {tag}_kurt"
    )


@register(
    "compare_moments",
    base(*_TREE_CTES)
    + "\nUNION ALL\n".join(
        f"SELECT * FROM (SELECT '{x}' AS \"column\", {_moment_sql('tr', 'train', x)} FROM tr)"
        f" CROSS JOIN (SELECT {_moment_sql('te', 'test', x)} FROM te)"
        for x in _TREE_COLS
    ),
)
def compare_moments(spark, sf):
    train, test = _tree_pair(spark, sf)
    return finish(P.compare_moments(train, test, _TREE_COLS))


def _shares_sql(src: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{x}' AS feature, CAST({q(x)} AS DOUBLE) AS value,"
        f" count(*) / (SELECT count({q(x)}) FROM {src}) AS share FROM {src} WHERE {q(x)} IS NOT NULL GROUP BY 2"
        for x in _TREE_COLS
    )


@register(
    "stability_index",
    base(*_TREE_CTES, f"sa AS ({_shares_sql('tr')})", f"sb AS ({_shares_sql('te')})")
    + "SELECT f.feature, " + r6("COALESCE(s.ss, 0) / (SELECT count(*) FROM tr)") + " AS stability_index FROM ("
    + " UNION ALL ".join(f"SELECT '{x}' AS feature" for x in _TREE_COLS)
    + ") f LEFT JOIN (SELECT sa.feature, SUM((sa.share - sb.share) ** 2) AS ss FROM sa JOIN sb"
    " ON sa.feature = sb.feature AND sa.value = sb.value GROUP BY 1) s ON f.feature = s.feature",
)
def stability_index(spark, sf):
    train, test = _tree_pair(spark, sf)
    return finish(P.stability_index(train, test, _TREE_COLS))


_ALIGN_COLS = ["Age", "Class_Economy", "Online_Boarding_3"]


@register(
    "aligned_value_shares",
    base(*_TREE_CTES, f"sa AS ({_shares_sql('tr')})", f"sb AS ({_shares_sql('te')})")
    + f"SELECT sa.feature, sa.value, {r6('sa.share')} AS share_a, {r6('sb.share')} AS share_b FROM sa JOIN sb"
    " ON sa.feature = sb.feature AND sa.value = sb.value WHERE sa.feature IN ("
    + ", ".join(f"'{x}'" for x in _ALIGN_COLS) + ")",
)
def aligned_value_shares(spark, sf):
    train, test = _tree_pair(spark, sf)
    return finish(P.inner_on_value(P.value_shares(train, _ALIGN_COLS), P.value_shares(test, _ALIGN_COLS)))


_CORR_COLS = S.NUMERIC + S.SURVEY + [S.TARGET]


@register(
    "correlation_pairs",
    base()
    + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r6(f'corr({q(a)}, {q(b)})')} AS r FROM train"
        for a in _CORR_COLS for b in _CORR_COLS
    ),
)
def correlation_pairs(spark, sf):
    return finish(P.correlation_matrix(train_frame(spark, sf), _CORR_COLS))


_INTER_SQL = (
    "qe AS (SELECT quantile_cont(CAST(\"Flight Distance\" AS DOUBLE), [0, 0.25, 0.5, 0.75, 1]) AS e FROM raw_train),"
    " ql AS (SELECT e, [ROUND(e[1], 3), ROUND(e[2], 3), ROUND(e[3], 3), ROUND(e[4], 3), ROUND(e[5], 3)] AS r FROM qe)"
)


def _qd_case(col):
    whens = []
    for i in range(1, 5):
        lo, hi = f"(SELECT e[{i}] FROM ql)", f"(SELECT e[{i + 1}] FROM ql)"
        left = f"CAST((SELECT r[{i}] FROM ql){' - 0.001' if i == 1 else ''} AS VARCHAR)"
        right = f"CAST((SELECT r[{i + 1}] FROM ql) AS VARCHAR)"
        cond = f"{col} >= {lo} AND {col} <= {hi}" if i == 1 else f"{col} > {lo} AND {col} <= {hi}"
        whens.append(f"WHEN {cond} THEN '(' || {left} || ', ' || {right} || ']'")
    return "CASE " + " ".join(whens) + " END"


_INTER_VALUES = {
    "Class_SeatComfort": "\"Class\" || '_' || CAST(\"Seat Comfort\" AS VARCHAR)",
    "TravelType_FlightDistance": "\"Type of Travel\" || '_' || qd",
    "OnlineBooking_OnlineBoarding": "CAST(\"Ease of Online booking\" AS VARCHAR) || '_' || CAST(\"Online Boarding\" AS VARCHAR)",
    "FlightDistance_SeatComfort": "qd || '_' || CAST(\"Seat Comfort\" AS VARCHAR)",
    "InflightWifi_FlightDistance": "CAST(\"Inflight Wifi Service\" AS VARCHAR) || '_' || qd",
}


@register(
    "label_counts_by_interaction",
    base(_INTER_SQL, f"t AS (SELECT *, {_qd_case(q('Flight Distance'))} AS qd FROM raw_train)")
    + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS feature, {expr} AS value, \"Satisfaction Rating\", count(*) AS count FROM t"
        f" WHERE value IS NOT NULL GROUP BY 2, 3"
        for name, expr in _INTER_VALUES.items()
    ),
)
def label_counts_by_interaction(spark, sf):
    raw = AN.interaction_features(FX.raw_train(spark, sf))
    return AN.label_counts(raw, S.INTERACTION_FEATURES)


@register(
    "age_density_train_test",
    base(
        "tr AS (SELECT CAST(Age AS DOUBLE) AS v FROM train), te AS (SELECT CAST(Age AS DOUBLE) AS v FROM test)",
        "st AS (SELECT 'train' AS side, count(v) AS n, stddev_samp(v) * POWER(count(v), -0.2) AS bw,"
        " min(v) AS lo, max(v) AS hi FROM tr UNION ALL SELECT 'test', count(v), stddev_samp(v) * POWER(count(v), -0.2),"
        " min(v), max(v) FROM te)",
        "g AS (SELECT side, n, bw, CAST(i AS INTEGER) AS i, lo - 3 * bw + i * ((hi + 3 * bw) - (lo - 3 * bw)) / 199 AS x"
        " FROM st, range(200) t(i))",
        "pts AS (SELECT 'train' AS side, v FROM tr UNION ALL SELECT 'test', v FROM te)",
    )
    + "SELECT g.side, g.i, " + r6("any_value(g.x)") + " AS x, "
    + r6("SUM(EXP(-0.5 * ((g.x - pts.v) / g.bw) ** 2)) / (any_value(g.n) * any_value(g.bw) * SQRT(2 * PI()))")
    + " AS density FROM g JOIN pts ON g.side = pts.side GROUP BY g.side, g.i",
)
def age_density_train_test(spark, sf):
    return finish(P.density_table(train_frame(spark, sf), test_frame(spark, sf), "Age"))


@register(
    "distinct_counts",
    base()
    + "\nUNION ALL\n".join(
        f"SELECT '{x}' AS \"column\", count(DISTINCT {q(x)}) + max(CASE WHEN {q(x)} IS NULL THEN 1 ELSE 0 END)"
        f" AS distinct FROM passengers"
        for x in S.RAW_COLUMNS
    ),
)
def distinct_counts(spark, sf):
    return P.distinct_counts(FX.passengers(spark, sf), S.RAW_COLUMNS)


@register(
    "column_modes",
    base()
    + "\nUNION ALL\n".join(
        f"SELECT '{x}' AS \"column\", CAST((SELECT {q(x)} FROM train WHERE {q(x)} IS NOT NULL GROUP BY 1"
        f" ORDER BY count(*) DESC, 1 LIMIT 1) AS DOUBLE) AS mode"
        for x in [*S.NUMERIC, *S.SURVEY]
    ),
)
def column_modes(spark, sf):
    return P.modes(train_frame(spark, sf), [*S.NUMERIC, *S.SURVEY])
