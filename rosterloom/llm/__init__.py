"""Operations of a training-data pipeline: ten operators and their registered queries.

Nothing else in the library imports this subpackage.
"""
