"""Model inputs: flight price features and user classification features.

Categorical columns are dictionary-encoded on the *full* table before any
split (so train and test share codes), dates become month / weekday /
weekend, and the resulting numeric columns are what the models consume.
Codes stay plain numeric columns (no ML attribute metadata), so tree models
treat them as continuous, as the original models did.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import date_features
from ..operators import encoding as E

# The feature names and their order are the models' interface.
FLIGHT_CATEGORICALS = ["from", "to", "flightType", "agency"]
FLIGHT_FEATURES = ["time", "distance", "from_encoded", "to_encoded", "flightType_encoded",
                   "agency_encoded", "month", "day_of_week", "is_weekend"]
# The tracked-experiment variant has no weekend flag.
FLIGHT_FEATURES_8 = FLIGHT_FEATURES[:-1]

USER_FEATURES = ["age", "company_encoded", "avg_flight_price", "total_flight_spent", "flight_count",
                 "avg_distance", "total_distance", "avg_flight_time", "first_class_count",
                 "avg_hotel_total", "total_hotel_spent", "hotel_booking_count", "avg_stay_days",
                 "total_stay_days", "avg_hotel_price_per_day"]
USER_FEATURES_SLIM = ["age", "company_encoded", "avg_price", "total_spent", "flight_count",
                      "avg_distance", "avg_hotel", "hotel_count"]
# Legacy request field names accepted by the classifier API.
USER_FEATURE_ALIASES = {"avg_price": "avg_flight_price", "total_spent": "total_flight_spent",
                        "avg_hotel": "avg_hotel_total", "hotel_count": "hotel_booking_count",
                        "avg_days": "avg_stay_days"}


def flight_dictionaries(flights: DataFrame) -> DataFrame:
    """The sorted distinct values of all categorical columns: one row, one pass."""
    return E.dictionary_row(flights, FLIGHT_CATEGORICALS)


def flight_features(flights: DataFrame, dictionaries: DataFrame | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """Encoded categoricals + date features; unseen values encode to 0.

    Only features whose source column exists are produced (a request table
    without a date column gets no date features unless it carries them).
    """
    dictionaries = dictionaries if dictionaries is not None else flight_dictionaries(flights)
    df = E.encode_columns(flights, dictionaries, [c for c in dictionaries.columns if c in flights.columns])
    if "date" in df.columns and "month" not in df.columns:
        df = df.select("*", *date_features("date"))
    keep = keep or []
    cols = [c for c in keep if c in df.columns] + [c for c in FLIGHT_FEATURES if c in df.columns]
    if "price" in df.columns and "price" not in cols:
        cols.append("price")
    return df.select(*cols)


def user_model_table(user_feats: DataFrame, company_dict: DataFrame | None = None,
                     gender_dict: DataFrame | None = None) -> DataFrame:
    """user_features + company code + label code (gender, alphabetical)."""
    company_dict = company_dict if company_dict is not None else E.build_dictionary(user_feats, "company")
    df = E.encode(user_feats, "company", company_dict)
    if "gender" in df.columns:
        gender_dict = gender_dict if gender_dict is not None else E.build_dictionary(user_feats, "gender")
        df = E.encode(df, "gender", gender_dict, "label", unseen=None)
    return df


def request_features(requests: DataFrame, company_dict: DataFrame) -> DataFrame:
    """Classification requests as model inputs: legacy names applied, an unseen
    or missing company is code 0, any other missing feature (or column) is 0."""
    df = apply_aliases(requests)
    if "company" not in df.columns:
        df = df.withColumn("company", F.lit(None).cast("string"))
    df = E.encode(df, "company", company_dict)
    names = {c: F.col(c) if c in df.columns else F.lit(None).cast("double") for c in USER_FEATURES}
    return df.select("request_id", *[F.coalesce(x.cast("double"), F.lit(0.0)).alias(c) for c, x in names.items()])


def apply_aliases(requests: DataFrame) -> DataFrame:
    """Map legacy feature names onto current ones when the current one is absent/NULL."""
    df = requests
    for old, new in USER_FEATURE_ALIASES.items():
        if old in df.columns:
            if new in df.columns:
                df = df.withColumn(new, F.coalesce(F.col(new), F.col(old)))
            else:
                df = df.withColumn(new, F.col(old))
    return df
