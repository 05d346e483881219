from datetime import date, datetime, timedelta, timezone

from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from clicktide.functions import utc_date
from clicktide.schemas import USER_SEGMENT
from clicktide.sinks import write_report_csv
from clicktide.sources import read_report_csv
from tests.helpers import as_list, as_set
from tests.test_properties import few

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


@few
@given(st.lists(st.integers(-4_000_000_000_000_000, 4_000_000_000_000_000), min_size=1))
def test_utc_date_of_any_moment(spark, micros):
    micros = [*micros, -1, 0, 86_399_999_999, 86_400_000_000, -86_400_000_000, -86_400_000_001]
    rows = spark.createDataFrame([(value,) for value in micros], "micros BIGINT")
    dates = rows.select(utc_date(F.timestamp_micros("micros")))
    expected = [(EPOCH + timedelta(microseconds=value)).date() for value in micros]
    assert [day for (day,) in as_list(dates)] == expected


def test_no_time_no_date(spark):
    assert spark.range(1).select(utc_date(F.lit(None).cast("timestamp"))).first()[0] is None
    assert spark.range(1).select(utc_date(F.timestamp_seconds(F.lit(0)))).first()[0] == date(1970, 1, 1)


@few
@given(st.sets(st.text(
    st.characters(codec="utf-8", exclude_characters="\0"), max_size=6,
), max_size=30))
def test_any_text_survives_a_csv_report(spark, tmp_path_factory, texts):
    folder = str(tmp_path_factory.mktemp("csv") / "report")
    rows = {(text, 1, 2, 3, text) for text in texts}
    write_report_csv(spark.createDataFrame(sorted(rows), USER_SEGMENT), folder)
    assert as_set(read_report_csv(spark, folder, USER_SEGMENT)) == rows
