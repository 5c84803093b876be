"""Training-data operators: ten corpus operators and their registered queries.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""
