"""Comparison of a query with its SQL."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, differences  # noqa: E402


def check_sql(df, sf, sql):
    assert differences(df, connect(sf), sql) is None
