import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from areafacts.session import sized_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from areafacts.session import local_session

    os.chdir(tmp_path_factory.mktemp("cwd"))
    session = local_session(
        8,
        settings={
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def sizes_as_before(request):
    """A job that sizes the shared session for its input leaves it as the next test expects it."""
    if "spark" not in request.fixturenames:
        yield
        return
    session = request.getfixturevalue("spark")
    before = {key: session.conf.get(key, None) for key in sized_settings(0, 1)}
    yield
    for key, value in before.items():
        session.conf.unset(key) if value is None else session.conf.set(key, value)


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return collect


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
