"""Bindings of the operators to the driver's test tables.

The test tables carry none of the original columns, so ``views`` maps them to
the neutral input frames and ``oracle`` holds the same mapping in DuckDB SQL.
Both must stay in step: every constant used by one is defined here once.
"""
