import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from forgelake.functions.timeparse import first_shown, shown_once, with_read_time
from forgelake.operators.timezones import estimate_zones, to_instants

EPOCH = datetime(1970, 1, 1)


def us(text):
    return int((datetime.fromisoformat(text) - EPOCH) / timedelta(microseconds=1))


@pytest.mark.parametrize("text, local, offset, kind", [
    ("2024-02-29T10:11:12Z", "2024-02-29T10:11:12", 0, "zoned"), ("2024-02-29t10:11:12z", "2024-02-29T10:11:12", 0, "zoned"), ("2023-02-29T10:11:12Z", None, None, "none"), ("2024-01-10T25:00:00", None, None, "none"),
    ("2024-01-10 09:08:07,123456789", "2024-01-10T09:08:07.123456", None, "local"), ("2024-01-10T09:08:07.5+05:30", "2024-01-10T09:08:07.500000", 19800, "zoned"), ("2024-01-10T09:08:07-03", "2024-01-10T09:08:07", -10800, "zoned"),
    ("20240110T090807-0330", "2024-01-10T09:08:07", -12600, "zoned"), ("2024/01/10 09:08", "2024-01-10T09:08:00", None, "local"), ("24.12.2020 19:58:03", "2020-12-24T19:58:03", None, "local"),
    ("Fri, 27 Jun 2025 09:46:16 +0900", "2025-06-27T09:46:16", 32400, "zoned"), ("Tue, 25 Jan 2022 04:52:47 GMT", "2022-01-25T04:52:47", 0, "zoned"), ("May 7, 2021, 12:17 AM UTC", "2021-05-07T00:17:00", 0, "zoned"),
    ("May 7, 2021, 12:17 PM GMT-4", "2021-05-07T12:17:00", -14400, "zoned"), ("May 7, 2021, 13:17 PM UTC", None, None, "none"), ("2022-08-12 05:20:59 EDT", "2022-08-12T05:20:59", -14400, "zoned"), ("2022-08-12 05:20:59 XYZ", None, None, "none"),
    ("2022-08-12 05:20:59 +1900", None, None, "none"), ("1683097727", "2023-05-03T07:08:47", None, "epoch"), ("1741330780759", "2025-03-07T06:59:40.759", None, "epoch"), ("  2024-01-10T09:08:07  ", "2024-01-10T09:08:07", None, "local"),
    ("yesterday", None, None, "none"), ("", None, None, "none"), (None, None, None, "none"), ("x" * 100_000, None, None, "none"), ("2024-01-10T23:59:60Z", None, None, "none"),
])
def test_read(spark, text, local, offset, kind):
    r = with_read_time(spark.createDataFrame([(text,)], "v string"), "v").first().t
    assert (r.kind, r.offset_s, r.local_us) == (kind, offset, None if local is None else us(local))


def test_local_times_against_zone_rules(spark):
    rng = random.Random(3)
    zones = ["Europe/Berlin", "America/New_York", "Australia/Sydney", "Asia/Kolkata", "Australia/Lord_Howe", "America/Sao_Paulo", "UTC"]
    times = [datetime(2015, 1, 1) + timedelta(seconds=rng.randrange(10 * 365 * 86400)) for _ in range(300)] + [datetime(2021, m, d, h, 30) for m, d in ((3, 28), (10, 31), (3, 14), (11, 7), (4, 4), (10, 3)) for h in range(4)]
    data = [(int((t - EPOCH) / timedelta(microseconds=1)), z) for t in times for z in zones]
    got = spark.createDataFrame(data, "l bigint, z string").select("l", "z", shown_once(F.col("l"), F.col("z"), first_shown(F.col("l"), F.col("z"))).alias("u")).collect()
    for r in got:
        t, zone = EPOCH + timedelta(microseconds=r.l), ZoneInfo(r.z)
        shown = {u for f in (0, 1) if (u := t.replace(tzinfo=zone, fold=f).astimezone(timezone.utc)).astimezone(zone).replace(tzinfo=None) == t}
        want = int((shown.pop().replace(tzinfo=None) - EPOCH) / timedelta(microseconds=1)) if len(shown) == 1 else None
        assert r.u == want, (t, r.z)


def test_estimated_zone(spark):
    """Local times of a clock in Sydney, ingested an hour later: no declared zone, so the zone is found."""
    zone, data = ZoneInfo("Australia/Sydney"), []
    for i in range(200):
        u = datetime(2023, 1, 1, tzinfo=timezone.utc) + timedelta(hours=37 * i)
        local = u.astimezone(zone).replace(tzinfo=None)
        data.append(("a", int((local - EPOCH) / timedelta(microseconds=1)), None, int((u.replace(tzinfo=None) + timedelta(hours=1) - EPOCH) / timedelta(microseconds=1))))
    observed = spark.createDataFrame([*data, *data, (None, 1, None, None), ("b", None, None, None)], "source string, local_us bigint, not_before_us bigint, not_after_us bigint")
    declared = spark.createDataFrame([("x", "Europe/Berlin"), ("y", "Australia/Sydney"), ("z", "Asia/Kolkata"), (None, "UTC"), ("q", None)], "source string, zone_name string")
    r = estimate_zones(observed, declared).collect()
    assert [(x.source, x.zone, x.basis, x.n, x.violations) for x in r] == [("a", "Australia/Sydney", "estimated", 400, 0)]
    wrong = spark.createDataFrame([("a", "America/New_York"), ("y", "Australia/Sydney")], "source string, zone_name string")
    assert estimate_zones(observed, wrong).first().zone == "Australia/Sydney"


def test_instants_keep_rows(spark, rows):
    zones = spark.createDataFrame([("a", "Europe/Berlin", "declared"), ("b", "Europe/Berlin", "estimated")], "source string, zone string, basis string")
    df = spark.createDataFrame([(1, "2021-03-28T02:30:00", "a"), (2, "2021-10-31T02:30:00", "a"), (3, "2021-07-01T12:00:00", "b"), (3, "2021-07-01T12:00:00", "b"), (4, "2021-07-01T12:00:00", None), (5, None, "a"), (6, "1600000000", "z")], "zone int, v string, source string")
    got = rows(to_instants(df, "v", "source", zones).select("zone", "utc_us", "status"))
    noon = us("2021-07-01T10:00:00")
    assert got == sorted([(1, None, "ambiguous"), (2, None, "ambiguous"), (3, noon, "estimated"), (3, noon, "estimated"), (4, None, "no_zone"), (5, None, "unreadable"), (6, 1_600_000_000_000_000, "exact")], key=repr)
    assert to_instants(df.limit(0), "v", "source", zones).count() == 0
