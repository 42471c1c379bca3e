import pytest

from keelstone import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        # One session runs all tests; the default is too little for the plans that it remembers.
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Change Spark SQL options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    """Physical plan of `df` after it ran, as text."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


def rows(data):
    """Sorted rows of a frame or list; NaN becomes text, so that it equals itself."""
    found = data if isinstance(data, list) else data.collect()
    plain = [tuple("NaN" if v != v else v for v in row) for row in found]
    return sorted(plain, key=repr)
