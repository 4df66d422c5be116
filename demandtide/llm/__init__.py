"""Training-data operators: one module each, their queries in ``queries``, their SQL in ``sql``.

Nothing else in the package imports this subpackage.
"""
