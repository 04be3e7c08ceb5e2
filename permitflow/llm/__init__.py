"""Training-data operators: ten corpus operators, their registered queries and the corpus pipeline's parts.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries when it can be imported.
"""
