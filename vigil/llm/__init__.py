"""Training-data operators: ten large-scale corpus operators and the modules of their queries.

Nothing else in the library imports this subpackage. Operators live in one module each; ``queries``
registers them under the names ``op1_...`` to ``op10_...`` and ``pipeline``.
"""
