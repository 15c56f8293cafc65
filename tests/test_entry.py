"""The SQL builds with neither a session nor Spark's jar folder; the stop words are Spark's."""

import subprocess
import sys
from pathlib import Path

from pyspark.ml.feature import StopWordsRemover

from postpulse.functions.lexicons import ENGLISH_STOP_WORDS

ROOT = Path(__file__).parent.parent


def test_sql_builds_without_session_and_jars():
    code = (
        "import glob, zipfile; glob.glob = lambda *a, **k: []; zipfile.ZipFile = None\n"
        "import __spark_entry__ as e; sql = e.oracle_sql(); assert len(sql) >= 74, len(sql)\n"
        "assert set(sql) <= set(e.queries())"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_stop_words_are_those_of_spark(spark):
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
