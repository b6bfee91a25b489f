"""Compare a registered query with its SQL on the smallest tables."""

from __future__ import annotations

from oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


def sql_difference(spark, name: str) -> str | None:
    return compare(spark, connect(SF_DIR), name, SF_DIR)
