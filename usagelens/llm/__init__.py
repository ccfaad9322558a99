"""Training-data operators (language ID, quality, dedup, packing, ...).

Nothing outside this package imports it; ``queries.py`` binds the operators to the
``documents`` / ``conversations`` / ``labels`` / ``benchmark`` tables.
"""
