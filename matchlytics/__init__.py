"""Match-event analytics as DataFrame-to-DataFrame operators.

``functions``  columns in, column out
``operators``  generic relational operators, parameterised by column names
``sources``    raw JSON kinds, Parquet tables
``plans``      the operators bound to match data: dimensions, facts, statistics, reports
"""
