"""The entry module loads, and composes all SQL, without Java, a session or Spark's jars."""

from __future__ import annotations

import os
import subprocess
import sys

from threadwright.functions.vocab import ENGLISH_STOP_WORDS

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import glob, os, pyspark
found, listed, opened = glob.glob, os.listdir, open
glob.glob = lambda p, **k: [] if "jars" in str(p) else found(p, **k)
import __spark_entry__ as entry
from pyspark import SparkContext
sql, queries = entry.oracle_sql(), entry.queries()
assert set(sql) <= set(queries) and len(sql) > 150 and all(isinstance(x, str) for x in sql.values())
assert SparkContext._active_spark_context is None
"""


def test_entry_and_sql_need_no_jars():
    env = {**os.environ, "JAVA_HOME": "/nonexistent", "SPARK_HOME": "/nonexistent"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=ROOT, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_stop_words_are_sparks_own(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(StopWordsRemover.loadDefaultStopWords("english")) == ENGLISH_STOP_WORDS
