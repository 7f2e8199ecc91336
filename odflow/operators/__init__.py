"""Operators: functions from DataFrames to DataFrames.

None of them acts on the driver with data. Joins carry no broadcast hint: the
planner broadcasts a side only when its size is below the session's threshold
and shuffles otherwise, where adaptive execution splits skewed keys.
"""
