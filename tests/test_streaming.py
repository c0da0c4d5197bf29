import datetime as dt
import shutil

from helpers import Sheet, cells_frame

from dayledger.sources.catalog import Catalog
from dayledger.streaming.arrivals import load_arrivals, read_arrivals


def test_arrivals_are_loaded_once(spark, filled, tmp_path):
    shutil.copytree(filled, tmp_path / "mart")
    catalog = Catalog(spark, str(tmp_path / "mart"))
    inbox, checkpoint = str(tmp_path / "inbox"), str(tmp_path / "checkpoint")

    def arrive(sheet):
        cells_frame(spark, sheet).coalesce(1).write.mode("append").parquet(inbox)
        query = load_arrivals(
            read_arrivals(spark, inbox), catalog, dt.date(2025, 2, 1), checkpoint
        )
        query.awaitTermination(300)
        return catalog.table("daily_well_parameters").count()

    assert arrive(Sheet("a").readings("1", "2", "3", "4").well("10").end()) == 1
    assert arrive(Sheet("b", date="1/3/2025").readings("2", "3", "4", "5").well("10").end()) == 2
    assert {r["file"] for r in catalog.findings().collect()} == {"a", "b"}
