import pytest


@pytest.fixture(scope="session")
def spark():
    from checks.compare import session

    made = session(4)
    yield made
    made.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
