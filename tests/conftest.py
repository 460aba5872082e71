import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cardspark.session import local_session

    os.chdir(tmp_path_factory.mktemp("cwd"))
    session = local_session(4, "4g", "cardspark-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    session.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
    yield session
    session.stop()


@pytest.fixture
def house(spark, tmp_path):
    import uuid

    from cardspark.plans.warehouse import Warehouse

    schema = "w" + uuid.uuid4().hex
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/schema'")
    return Warehouse(spark, str(tmp_path / "tables"), schema)


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
