"""What must not be lost without a word."""

from __future__ import annotations

from folioworks.sources.landing import missing_pages


def test_every_page_number_is_needed(spark):
    def gaps(*numbers):
        return missing_pages(spark.createDataFrame([(n, 3) for n in numbers], "page bigint, total_pages bigint")).count()

    assert gaps(1, 2, 3) == 0 and gaps(1, 1, 2, 3) == 0
    assert gaps(2, 3, 4) == 1 and gaps(1, 3) == 1 and gaps(1, 2, 3, 4) == 1
