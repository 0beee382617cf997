"""Operations for training-data pipelines: one module per operator.

Every operator is a function from DataFrames to a DataFrame with its own
general interface; :mod:`paddock.llm.queries` applies them to the test tables.
"""
