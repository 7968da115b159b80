"""Operations of a training-data pipeline over document tables.

One module per operator, ``queries`` registers them.  Nothing else in the
library imports this package.
"""
