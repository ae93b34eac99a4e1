"""Column names, types and the fixed value lists of the survey problem."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "id"
TARGET = "Satisfaction_Rating"
RAW_TARGET = "Satisfaction Rating"

# ---------------------------------------------------------------------------
# FIXED VALUES -- these must equal the reference's for identical results
# (column names, label maps, bin edges and labels, feature lists).
# ---------------------------------------------------------------------------

RAW_SURVEY_COLUMNS = [
    "Ease of Online booking",
    "Convenience of Departure/Arrival Time ",
    "Baggage Handling",
    "Check-In Service",
    "Gate Location",
    "Online Boarding",
    "Inflight Wifi Service",
    "Food and Drink",
    "Seat Comfort",
    "Inflight Entertainment",
    "On-Board Service",
    "Leg Room",
    "Inflight Service",
    "Cleanliness",
]

RAW_COLUMNS = [
    "id",
    "Gender",
    "Customer Type",
    "Age",
    "Type of Travel",
    "Class",
    "Flight Distance",
    "Departure Delay in Minutes",
    "Arrival Delay in Minutes",
    *RAW_SURVEY_COLUMNS,
    "Satisfaction Rating",
]

RATING_LABELS = {"Neutral / Dissatisfied": 0, "Satisfied": 1}

# notebook label codes
NOTEBOOK_CODES = {
    "Gender": {"Female": 0, "Male": 1},
    "Customer_Type": {"Loyal Customer": 0, "Non-Loyal Customer": 1},
    "Type_of_Travel": {"Business": 0, "Personal": 1},
    "Class": {"Business": 0, "Economy": 1, "Economy Plus": 2},
}

CATEGORICAL = ["Gender", "Customer_Type", "Type_of_Travel", "Class"]
NUMERIC = ["Age", "Flight_Distance", "Departure_Delay_in_Minutes", "Arrival_Delay_in_Minutes"]

SERVICE = [
    "Ease_of_Online_booking",
    "Check-In_Service",
    "Online_Boarding",
    "Inflight_Wifi_Service",
    "On-Board_Service",
    "Inflight_Service",
]
COMFORT = ["Seat_Comfort", "Leg_Room", "Inflight_Entertainment", "Food_and_Drink", "Cleanliness"]
CONVENIENCE = ["Convenience_of_Departure/Arrival_Time_", "Baggage_Handling", "Gate_Location"]
GROUPS = {"service": SERVICE, "comfort": COMFORT, "convenience": CONVENIENCE}

# feature-engineering bins: (edges, labels), right-closed
AGE_BINS = ([0, 18, 35, 60, 100], ["Child", "Young_Adult", "Adult", "Senior"])
DISTANCE_BINS = ([0, 500, 1500, 5000], ["Short-Haul", "Medium-Haul", "Long-Haul"])
DELAY_DIFF_BINS = ([float("-inf"), -5, 5, float("inf")], ["Made_Up_Time", "No_Delay_Change", "Lost_Time"])

# analysis bins: (edges, labels), left-closed
AGE_GROUP_BINS = ([18, 25, 35, 45, 55, 65, 75, 100], ["18-25", "26-35", "36-45", "46-55", "56-65", "66-75", "75+"])
DELAY_GROUP_BINS = ([0, 15, 60, 180, 360, 720, 1440], ["<15min", "15-60min", "1-3hrs", "3-6hrs", "6-12hrs", "12-24hrs"])

# products made by the full feature set, in order
INTERACTIONS = [
    ("Online_Boarding", "Ease_of_Online_booking"),
    ("Seat_Comfort", "Leg_Room"),
    ("Inflight_Entertainment", "Flight_Distance"),
    ("Food_and_Drink", "Flight_Distance"),
    ("Age", "Type_of_Travel_Personal"),
    ("Gender_Male", "Inflight_Wifi_Service"),
    ("Departure_Delay_in_Minutes", "Arrival_Delay_in_Minutes"),
    ("Age", "Inflight_Entertainment"),
    ("Class_Economy", "Cleanliness"),
    ("Class_Economy_Plus", "Cleanliness"),
    ("Customer_Type_Non-Loyal_Customer", "On-Board_Service"),
    ("Class_Economy", "Flight_Distance"),
    ("Class_Economy_Plus", "Flight_Distance"),
]

# feedback consistency differences: (name, left, right)
CONSISTENCY_DIFFS = [
    ("diff_inflight_onboard_service", "Inflight_Service", "On-Board_Service"),
    ("diff_seatcomfort_legroom", "Seat_Comfort", "Leg_Room"),
    ("diff_wifi_onlineboarding", "Inflight_Wifi_Service", "Online_Boarding"),
    ("diff_food_cleanliness", "Food_and_Drink", "Cleanliness"),
]

SCORE_SUMS = [
    ("Service_Quality_Score", SERVICE),
    ("Comfort_Score", COMFORT),
    ("Convenience_Score", CONVENIENCE),
]

BEST_FEATURES = [
    "Age_x_Type_of_Travel_Personal",
    "Baggage_Handling",
    "Check-In_Service",
    "Class_Economy",
    "Class_Economy_Plus_x_Cleanliness",
    "Cleanliness",
    "Convenience_of_Departure/Arrival_Time_",
    "Customer_Type_Non-Loyal_Customer_x_On-Board_Service",
    "Departure_Delay_in_Minutes",
    "Ease_of_Online_booking",
    "Flight_Delay_Difference_Made_Up_Time",
    "Gate_Location",
    "Inflight_Entertainment",
    "Inflight_Service",
    "Inflight_Wifi_Service",
    "Leg_Room",
    "On-Board_Service",
    "Online_Boarding",
    "Online_Boarding_x_Ease_of_Online_booking",
    "Seat_Comfort",
    "Seat_Comfort_x_Leg_Room",
    "Type_of_Travel_Personal",
    "Age",
    "Flight_Distance_bins_Long-Haul",
    "Flight_Distance_bins_Medium-Haul",
]

LOW_IMPORTANCE = [
    "Departure_Delay_in_Minutes",
    "Departure_Delay_in_Minutes_x_Arrival_Delay_in_Minutes",
    "Flight_Distance",
    "Food_and_Drink",
    "FlightDistance_Class",
    "On-Board_Service",
    "Gender_TypeOfTravel",
    "Gender",
    "Food_SeatComfort",
    "Arrival_Delay_in_Minutes",
    "Age_x_Flight_Distance",
    "Flight_Distance_bins",
    "Age_bins",
    "OnBoard_InflightService",
    "Seat_Comfort_x_Leg_Room",
    "Online_Boarding_x_Ease_of_Online_booking",
]

# hard-vote weights of the three boosted/forest models
VOTE_WEIGHTS = [1.0, 1.0, 1.5]

# columns of the full feature set by encoding
FULL_ONEHOT = [
    "Gender",
    "Customer_Type",
    "Type_of_Travel",
    "Class",
    "Age_bins",
    "Flight_Distance_bins",
    "Flight_Delay_Difference",
]
FREQ_COLUMNS = ["Type_of_Travel", "Class", "Gender", "Customer_Type"]
POLY_COLUMNS = ["Flight_Distance", "Age", "Departure_Delay_in_Minutes", "Arrival_Delay_in_Minutes"]

# groups and interactions of the exploratory profile
GROUP_FEATURES = ["Age Group", "Departure Delay Group", "Arrival Delay Group"]
INTERACTION_FEATURES = [
    "Class_SeatComfort",
    "TravelType_FlightDistance",
    "OnlineBooking_OnlineBoarding",
    "FlightDistance_SeatComfort",
    "InflightWifi_FlightDistance",
]

# choice -> columns it selects (fixed values of the feature-subset search)
SELECTION_CHOICES: dict[str, dict[str, list[str]]] = {
    "Age_Selection": {
        "numerical": ["Age"],
        "bins": ["Age_bins_Young_Adult", "Age_bins_Adult", "Age_bins_Senior"],
        "squared": ["Age", "Age^2"],
        "cubed": ["Age", "Age^2", "Age^3"],
        "no_selection": [],
    },
    "Flight_Distance_Selection": {
        "numerical": ["Flight_Distance"],
        "bins": ["Flight_Distance_bins_Long-Haul", "Flight_Distance_bins_Medium-Haul"],
        "squared": ["Flight_Distance", "Flight_Distance^2"],
        "cubed": ["Flight_Distance", "Flight_Distance^2", "Flight_Distance^3"],
        "no_selection": [],
    },
    "Delay_Selection": {
        "numerical": ["Departure_Delay_in_Minutes", "Arrival_Delay_in_Minutes"],
        "total": ["Total_Delay_Minutes"],
        "categorical": ["Experienced_Delay"],
        "squared": [
            "Departure_Delay_in_Minutes",
            "Arrival_Delay_in_Minutes",
            "Departure_Delay_in_Minutes^2",
            "Arrival_Delay_in_Minutes^2",
        ],
        "cubed": [
            "Departure_Delay_in_Minutes",
            "Arrival_Delay_in_Minutes",
            "Departure_Delay_in_Minutes^2",
            "Arrival_Delay_in_Minutes^2",
            "Departure_Delay_in_Minutes^3",
            "Arrival_Delay_in_Minutes^3",
        ],
        "no_selection": [],
    },
    "Delay_Difference_Selection": {
        "numerical": ["Flight_Delay_Difference_Minutes"],
        "bins": ["Flight_Delay_Difference_Made_Up_Time", "Flight_Delay_Difference_Lost_Time"],
        "no_selection": [],
    },
}

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------


def normalize_name(name: str) -> str:
    """Header normalisation: every space becomes an underscore."""
    return name.replace(" ", "_")


SURVEY = [normalize_name(c) for c in RAW_SURVEY_COLUMNS]

RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("Gender", T.StringType()),
        T.StructField("Customer Type", T.StringType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Type of Travel", T.StringType()),
        T.StructField("Class", T.StringType()),
        T.StructField("Flight Distance", T.IntegerType()),
        T.StructField("Departure Delay in Minutes", T.IntegerType()),
        T.StructField("Arrival Delay in Minutes", T.DoubleType()),
        *[T.StructField(c, T.IntegerType()) for c in RAW_SURVEY_COLUMNS],
        T.StructField("Satisfaction Rating", T.StringType()),
    ]
)
