import pytest

from noticelake.session import build, ship


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build("local[4]", "tests", **{"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.sql.shuffle.partitions": "2", "spark.driver.memory": "2g"})
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()
