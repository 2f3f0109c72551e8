"""Small typed tables for the tests."""

from wayfare.sources.tables import FLIGHTS_SCHEMA, HOTELS_SCHEMA, USERS_SCHEMA


def users_df(spark, rows):
    return spark.createDataFrame(rows, USERS_SCHEMA)


def flights_df(spark, rows):
    return spark.createDataFrame(rows, FLIGHTS_SCHEMA)


def hotels_df(spark, rows):
    return spark.createDataFrame(rows, HOTELS_SCHEMA)
