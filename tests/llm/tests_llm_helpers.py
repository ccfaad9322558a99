"""Spark query against its DuckDB oracle over one of the given folders."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from helpers import duck, rows_digest, spark_rows  # noqa: E402

from usagelens.llm import queries  # noqa: E402


def compare_with_oracle(spark, sf_dir, name):
    cols, rows = spark_rows(queries.QUERIES[name](spark, sf_dir))
    con = duck(sf_dir)
    result = con.execute(queries.ORACLE[name])
    want_cols = [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(cols) == sorted(want_cols)
    got_hash, got_lines = rows_digest(cols, rows)
    want_hash, want_lines = rows_digest(want_cols, want)
    assert len(got_lines) == len(want_lines)
    assert got_hash == want_hash, [p for p in zip(got_lines, want_lines) if p[0] != p[1]][:3]
