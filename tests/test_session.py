import pytest
from pyspark.sql import functions as F

from clicktide.operators import sliding_window_counts, with_window_bounds
from clicktide.schemas import CLICKSTREAM
from clicktide.session import (
    DEFAULT_CONF,
    build_session,
    planned_bytes,
    shared_folder,
    shared_root,
    sized_for,
    sizing,
)
from clicktide.sinks import write_archive
from clicktide.sources import (
    load_events_for_date,
    parse_events,
    read_archive,
    to_alert_messages,
    to_event_messages,
)
from tests.helpers import as_list, at, event, events_of


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


class Session:
    def __init__(self, **conf):
        self.conf = Conf({key.replace("_", "."): value for key, value in conf.items()})


def test_session_is_in_utc_and_adaptive(spark):
    for key, value in DEFAULT_CONF.items():
        assert spark.conf.get(key) == value
    assert build_session(conf={"spark.sql.shuffle.partitions": "4"}) is not None


def test_shared_folder_is_below_the_clusters_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    application = spark.sparkContext.applicationId
    assert first.startswith(f"{root}/clicktide-{application}/x-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        shared_root(Session(spark_master="yarn"))
    assert shared_root(Session(spark_master="local[2]")).startswith("/")
    root = shared_root(Session(spark_master="yarn", spark_checkpoint_dir="hdfs://shared/"))
    assert root == "hdfs://shared"


@pytest.mark.parametrize("input_bytes, cores, split, partitions", [
    (0, 8, 128 * 2**20, 8),
    (10 * 2**30, 8, 320 * 2**20, 40),
    (300 * 2**30, 4000, 128 * 2**20, 4000),
    (100 * 2**40, 4000, 2**30, 50_000),
])
def test_sizing(input_bytes, cores, split, partitions):
    assert sizing(input_bytes, cores) == {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def test_most_partitions_is_a_parameter():
    assert sizing(100 * 2**40, 4000, 500_000)["spark.sql.shuffle.partitions"] == "409600"


def test_planned_bytes_follow_the_columns(spark, folder):
    rows = [event(user=f"user-{number}", time=at(number * 1440)) for number in range(4)]
    write_archive(events_of(spark, rows), folder)
    whole = read_archive(spark, folder)
    one = planned_bytes(whole.select("event_type"))
    assert 0 < one < planned_bytes(whole)
    assert planned_bytes(whole, whole.select("event_type")) == planned_bytes(whole) + one


def test_working_folders_go_with_the_application(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark, "test")).getParent()
    assert path.getFileSystem(spark._jsc.hadoopConfiguration()).cancelDeleteOnExit(path)


def test_sizing_is_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(KeyError), sized_for(spark, 100 * 2**30):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "400"
        raise KeyError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "Pacific/Auckland"])
def test_results_do_not_depend_on_the_sessions_zone(spark, folder, zone):
    rows = [event(user=f"u{number}", time=at(number * 97)) for number in range(40)]
    rows.append(event(time=None))

    def results(place):
        events = events_of(spark, rows)
        write_archive(events, place)
        counts = with_window_bounds(sliding_window_counts(events))
        plain = spark.createDataFrame(
            [('{"timestamp":"2026-01-01T00:00:00"}',), ('{"timestamp":"2026-03-08"}',)],
            "value STRING",
        )
        return [
            sorted(map(str, as_list(frame))) for frame in (
                events.select("user_id", "event_date"),
                to_event_messages(events),
                to_alert_messages(counts),
                parse_events(to_event_messages(events)).select("user_id", F.unix_micros("timestamp")),
                parse_events(plain).select(F.unix_micros("timestamp"), "event_date"),
                counts.select(F.unix_seconds("window_start"), F.unix_seconds("window_end"), "views"),
                load_events_for_date(spark, place, "2026-01-02").select("user_id", "event_date"),
            )
        ]

    in_utc = results(f"{folder}/utc")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        elsewhere = results(f"{folder}/elsewhere")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert elsewhere == in_utc


def test_event_time_is_a_zoned_type_whatever_the_default(spark):
    name = "spark.sql.timestampType"
    before = spark.conf.get(name)
    spark.conf.set(name, "TIMESTAMP_NTZ")
    try:
        assert dict(spark.createDataFrame([], CLICKSTREAM).dtypes)["timestamp"] == "timestamp"
    finally:
        spark.conf.set(name, before)
