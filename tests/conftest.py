import pytest

from tillwright.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = local_session(8, shuffle_partitions=4, app="tillwright-tests", conf=conf)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as a sorted list of tuples."""

    def collect(df, *names):
        shown = df.select(*names) if names else df
        return sorted((tuple(r) for r in shown.collect()), key=lambda r: [(v is not None, v) for v in r])

    return collect
