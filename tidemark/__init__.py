"""Market-sentiment lakehouse operators as plain DataFrame functions.

Every operator takes DataFrames and returns a DataFrame; nothing is read from
the wall clock, the moment of the run is always an ``as_of`` argument.
"""
