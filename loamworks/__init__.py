"""loamworks: corpus preparation operators on PySpark DataFrames."""
