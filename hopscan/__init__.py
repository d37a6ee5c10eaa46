"""hopscan: transposon-insertion sequencing time courses on Spark DataFrames.

Every operator takes and returns a DataFrame (or a Column), stays lazy, and keeps
tables long: one row per insertion x sample x timepoint.
"""

__version__ = "0.1.0"
