"""Loss-reserving analytics expressed as Spark DataFrame transformations.

Every operator takes DataFrames and column names and returns a lazy DataFrame;
nothing in the library collects rows to the driver or loops over segments.
"""
