"""Operators of a training-data pipeline: filtering, de-duplication, mixing,
packing, archives and search over text tables, and their registered queries.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its queries
when it is present.
"""
