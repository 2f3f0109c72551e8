"""wayfare: booking analytics (users, flights, hotel stays) on Spark DataFrames.

Every operator is a plain function ``op(df, ..., *, params) -> DataFrame``
built from the DataFrame/SQL API and ``pyspark.ml``; nothing is collected
to the driver except bounded dimension tables whose size is checked.
"""

__version__ = "0.1.0"
