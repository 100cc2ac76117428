"""Pages that land over time."""

import pytest

from leadsieve.streaming.incremental import current_sites, incremental_pages


def test_new_checkpoint_on_stored_sites_is_refused(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "https://a.com/", "<p>text</p>")], "page_id bigint, url string, html string") \
        .write.parquet(landing)
    incremental_pages(spark, landing, out, f"{out}/progress")
    with pytest.raises(ValueError):
        incremental_pages(spark, landing, out, f"{out}/other")
    assert current_sites(spark, out).count() == 1
