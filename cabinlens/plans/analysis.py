"""Exploratory profile of the raw train table: groups, interactions, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cabinlens import schema as S
from cabinlens.functions.exprs import c, cut
from cabinlens.operators import derive as D
from cabinlens.operators import profile as P

def group_features(raw: DataFrame) -> DataFrame:
    """Left-closed age and delay groups on raw-header columns."""
    return raw.withColumns(
        {
            "Age Group": cut(c("Age"), *S.AGE_GROUP_BINS, right=False),
            "Departure Delay Group": cut(c("Departure Delay in Minutes"), *S.DELAY_GROUP_BINS, right=False),
            "Arrival Delay Group": cut(c("Arrival Delay in Minutes"), *S.DELAY_GROUP_BINS, right=False),
        }
    )


def interaction_features(raw: DataFrame) -> DataFrame:
    """Five string interactions; the distance quartiles are fitted once."""
    qd = D.QuantileBins.fit(raw, ["Flight Distance"]).expr("Flight Distance")
    df = raw.withColumn("__qd", qd)
    df = D.concat_features(df, "Class_SeatComfort", ["Class", "Seat Comfort"])
    df = D.concat_features(df, "TravelType_FlightDistance", ["Type of Travel", "__qd"])
    df = D.concat_features(df, "OnlineBooking_OnlineBoarding", ["Ease of Online booking", "Online Boarding"])
    df = D.concat_features(df, "FlightDistance_SeatComfort", ["__qd", "Seat Comfort"])
    df = D.concat_features(df, "InflightWifi_FlightDistance", ["Inflight Wifi Service", "__qd"])
    return df.drop("__qd")


def label_counts(raw: DataFrame, features=None) -> DataFrame:
    """Counts per feature value and satisfaction label (data of the count plots)."""
    features = features or S.GROUP_FEATURES
    return P.crosstab_by_target(raw, features, S.RAW_TARGET)
