"""Discovery and the collection log."""

import json
from datetime import datetime

import pytest

from seriesloom.plans import medallion
from seriesloom.sources import payload

NOW = datetime(2026, 6, 30)
PAYLOAD = "indicator_id string, page int, payload string"


def test_discovery_finds_domains_in_a_table(spark):
    rows = ",".join('{"id":"%s","name":"N %s","unit":"","sourceNote":"note","source":{"value":"S"}}' % (c, c) for c in "ABCA")
    given = spark.createDataFrame([("meta", 1, f'[{{"pages":1}},[{rows},{{"name":"no id"}}]]'), ("meta", 2, "42")], PAYLOAD)
    table = spark.createDataFrame([("A", "trade"), ("A", "gdp"), ("B", " "), ("Z", "x")], "indicator_id string, domain string")
    for domains, want in ((table, {"A": "gdp", "B": "unclassified", "C": "unclassified"}), ({"B": "energy"}, {"A": "unclassified", "B": "energy", "C": "unclassified"})):
        found, wrong = payload.discovered(given, domains)
        assert {r["indicator_id"]: r["domain"] for r in found.collect()} == want and found.count() == 3
        assert wrong.count() == 1
    with pytest.raises(LookupError, match="no series: payload is neither"):
        payload.discovered(given.filter("page = 2"), table)


def test_the_collection_log_says_what_came_and_when(spark):
    row = '{"country":{"value":"X"},"date":"%d","value":1}'
    given = [("A", 1, f'[{{"pages":2,"lastupdated":"2026-01-01","sourceid":"2"}},[{row % 2003},{row % 2001}]]'), ("A", 2, f'[{{"pages":2}},[{row % 1999}]]'), ("B", 1, "42")]
    log = {r["indicator_id"]: r for r in medallion.collection_log(medallion.landed(spark.createDataFrame(given, PAYLOAD), "r", NOW)).collect()}
    assert (log["A"]["records_collected"], log["A"]["status"], len(log["A"]["bronze_ids"]), log["A"]["collection_timestamp"]) == (3, "success", 2, NOW)
    assert json.loads(log["A"]["metadata"]) == {"pages": 2, "last_updated": "2026-01-01", "source_id": "2", "country": "X", "first_date": "1999", "last_date": "2003"}
    assert (log["B"]["status"], log["B"]["records_collected"], len(log["B"]["bronze_ids"])) == ("failed", 0, 1)
