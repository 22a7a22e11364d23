"""Training-data pipeline operators on the ``documents`` / ``pages`` tables.

One module per operator; ``queries`` registers them.  Nothing else in the library
imports this package.
"""
