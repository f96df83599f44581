"""Training-data operators: ten corpus operators and their registered queries.

Nothing outside this package imports it (``__spark_entry__.py`` adds its
queries only if it can be imported).
"""
