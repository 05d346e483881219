from datetime import datetime, timezone

import pytest

from clicktide.sources.events_table import read_events
from tests.helpers import as_set

ROWS = """
    SELECT * FROM VALUES
        (1L, TIMESTAMP_NTZ '2024-01-01 23:59:59.5', 7L, 'click', 0.5D, '{"k": 0}'),
        (2L, TIMESTAMP_NTZ '2024-01-02 00:00:00', 12345L, 'view', 0.5D, '{"k": 23}'),
        (3L, TIMESTAMP_NTZ '2024-01-02 00:00:00', NULL, 'signup', 0.5D, '{}'),
        (4L, NULL, 8L, NULL, 0.5D, NULL)
    AS events(event_id, ts, user_id, event_type, value, props)
"""


@pytest.mark.parametrize("kind", ["TIMESTAMP_NTZ", "TIMESTAMP_LTZ"])
@pytest.mark.parametrize("files", [1, 3])
def test_table_is_read_in_any_layout(spark, folder, kind, files):
    table = spark.sql(ROWS)
    table = table.withColumn("ts", table["ts"].cast(kind))
    table.repartition(files).write.parquet(f"{folder}/events.parquet")

    def moment(*parts):
        return datetime(*parts, tzinfo=timezone.utc).astimezone().replace(tzinfo=None)

    first, second = moment(2024, 1, 1, 23, 59, 59, 500_000), moment(2024, 1, 2)
    events = read_events(spark, folder)
    assert as_set(events) == {
        ("U0007", "P001", "Laptops", "add_to_cart", first, first.date()),
        ("U12345", "P012", "Tablets", "view", second, second.date()),
        (None, None, None, "signup", second, second.date()),
        ("U0008", None, None, None, None, None),
    }
