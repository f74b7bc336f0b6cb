import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from prosestat.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, app="tests", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Evaluate a column builder on a list of strings."""
    def run(values, build):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r.out for r in df.select("i", build("v").alias("out")).orderBy("i").collect()]
    return run


START = "*** START OF THE PROJECT GUTENBERG EBOOK T ***"
END = "*** END OF THE PROJECT GUTENBERG EBOOK T ***"
OTHER_START = "*** Start of this Project Gutenberg EBook T ***"
OTHER_END = "*** End of this Project Gutenberg EBook T ***"
SAMPLE = "\n".join([
    "The old miller walked down to the river at dawn.",
    "Rain fell on the barn, and the goat slept.",
    "Nobody saw the grey cat near the stove.",
    "Did the baker forget the salt again?"])
