import shutil

import pytest
from helpers import fill_dimensions
from pyspark.sql import SparkSession

from dayledger.sources.catalog import Catalog


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("dayledger-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def filled(spark, tmp_path_factory):
    """A mart folder with dimensions and empty facts, to be copied."""
    folder = str(tmp_path_factory.mktemp("filled") / "mart")
    fill_dimensions(Catalog(spark, folder))
    return folder


@pytest.fixture
def catalog(spark, filled, tmp_path):
    shutil.copytree(filled, tmp_path / "mart")
    return Catalog(spark, str(tmp_path / "mart"))
