"""Training-data operators: ten methods for chat, quality, secrets, duplicates, packing, language, contamination and licences.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries (``QUERIES``) and their SQL counterparts (``ORACLES``).
"""
