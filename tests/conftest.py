import pytest

from sedimenta.session import get_session, ship


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", 4, 4, **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"})
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()
