from __future__ import annotations

import pytest

from frames import frame, rows, ts
from pyspark.sql import functions as F

from slotledger.operators import widen as w

ACTIVITIES = (
    "owner string, contact string, account string, lead_source string, subject string, "
    "type string, created_on timestamp_ntz, created_by string, description string"
)


def _activity(contact, when, subject):
    return ("o", contact, "a", "web", subject, "Call", ts(when), "me", f"about {subject}")


def test_layout(spark):
    df = frame(
        spark,
        ACTIVITIES,
        _activity("Ann", "2013-01-01", "s1"),
        _activity("Bob", "2013-01-03", "third"),
        _activity("Bob", "2013-01-01", "first"),
        _activity("Bob", "2013-01-02", "second"),
    )
    wide = w.widen(df, w.CONTACT_COLUMNS, "created_on", w.ACTIVITY_COLUMNS)
    assert wide.columns[:6] == ["Owner", "Contact", "Account", "Lead Source", "1 Subject", "1 Type"]
    assert wide.columns[-1] == "3 Description"
    assert len(wide.columns) == 4 + 3 * 5
    assert rows(wide, "Contact", "1 Subject", "2 Subject", "3 Subject") == [
        ("Ann", "s1", None, None),
        ("Bob", "first", "second", "third"),
    ]
    assert w.max_group_size(df, "contact").first()[0] == 3


def test_no_activities(spark):
    wide = w.widen(
        frame(spark, ACTIVITIES), w.CONTACT_COLUMNS, "created_on", w.ACTIVITY_COLUMNS
    )
    assert wide.columns == list(w.CONTACT_COLUMNS)
    assert wide.count() == 0


@pytest.fixture
def skewed(spark):
    """One contact with a third of all activities, many with a few."""
    return spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, -1, id % 2000) AS contact",
        "id * 7919 % 30011 AS created_on",
        "CONCAT('s', id) AS subject",
    )


def test_numbers_of_a_hot_contact(spark, skewed):
    numbered = w.number_activities(skewed, ["contact"], "created_on", ["subject"]).collect()
    by_contact: dict[int, list] = {}
    for r in numbered:
        by_contact.setdefault(r["contact"], []).append(r)
    assert len(numbered) == 30_000
    for group in by_contact.values():
        group.sort(key=lambda r: (r["created_on"], r["subject"]))
        assert [r["slot"] for r in group] == list(range(1, len(group) + 1))


def test_numbers_of_a_hot_contact_with_equal_times(spark):
    """Half of the hot contact's activities share one time."""
    df = spark.range(20_000).selectExpr(
        "IF(id % 3 = 0, -1, id % 2000) AS contact",
        "IF(id % 2 = 0, 100, id % 200) AS created_on",
        "CONCAT('s', id) AS subject",
    )
    numbered = w.number_activities(df, ["contact"], "created_on", ["subject"])
    hot = sorted(numbered.where("contact = -1").collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in hot] == list(range(1, len(hot) + 1))
    times = [r["created_on"] for r in hot]
    assert times == sorted(times)
    assert numbered.select("subject").distinct().count() == 20_000


def test_hot_contact_is_numbered_in_chunks(spark, skewed):
    hot, points = w._chunk_points(skewed, ["contact"], "created_on")
    assert hot == [skewed.select(F.xxhash64(F.lit(-1).cast(skewed.schema["contact"].dataType))).first()[0]]
    assert len(set(points)) > 100


def test_hot_contacts_are_found_in_one_pass(spark):
    """Contacts just above the share among very many small ones: all found, none of the small ones."""
    df = spark.range(0, 400_000, 1, 16).selectExpr(
        "IF(id % 100 = 0, -1, IF(id % 500 = 1, -2, id)) AS contact", "id AS created_on"
    )
    hot, points = w._chunk_points(df, ["contact"], "created_on")
    keys = spark.createDataFrame([(-1,), (-2,)], "contact long").select(F.xxhash64("contact")).collect()
    assert hot == sorted(r[0] for r in keys)
    assert points == sorted(points)


def test_long_contacts_go_on_over_pages(spark, skewed):
    wide = w.widen(
        skewed,
        {"Contact": "contact"},
        "created_on",
        {"Created On": "created_on", "Subject": "subject"},
        slots_per_row=w.SLOTS_PER_ROW,
    )
    assert "Page" in wide.columns
    hot = wide.where("Contact = -1").orderBy("Page").collect()
    assert [r["Page"] for r in hot] == list(range(1, 51))
    times = [r[f"{i} Created On"] for r in hot for i in range(1, w.SLOTS_PER_ROW + 1)]
    times = [t for t in times if t is not None]
    assert len(times) == 10_000 and times == sorted(times)
    subjects = [
        s for r in wide.collect() for c, s in r.asDict().items() if c.endswith("Subject") and s
    ]
    assert len(subjects) == len(set(subjects)) == 30_000


def test_columns_depend_on_the_arguments_alone(spark):
    """200 and 201 activities of a contact give the same columns."""
    titles = {"Contact": "contact"}, "created_on", {"Subject": "subject"}
    wide = []
    for n in (200, 201):
        df = spark.range(n).selectExpr("1 AS contact", "id AS created_on", "CONCAT('s', id) AS subject")
        wide.append(w.widen(df, *titles, slots_per_row=200))
        assert len(w.widen(df, *titles).columns) == n + 1
    assert wide[0].columns == wide[1].columns
    assert [x.count() for x in wide] == [1, 2]


def test_hot_contact_without_key_or_order_values(spark):
    """A NULL in a key, and NULL times, are cut into chunks and numbered like others."""
    df = spark.range(6_000).selectExpr(
        "IF(id % 3 = 0, -1, id % 2000) AS contact",
        "IF(id % 3 = 0, NULL, 'o') AS owner",
        "IF(id % 2 = 0, NULL, id % 50) AS created_on",
        "CONCAT('s', id) AS subject",
    )
    assert len(w._chunk_points(df, ["contact", "owner"], "created_on")[0]) == 1
    numbered = w.number_activities(df, ["contact", "owner"], "created_on", ["subject"])
    hot = numbered.where("contact = -1").orderBy("slot").collect()
    assert [r["slot"] for r in hot] == list(range(1, 2001))
    times = [r["created_on"] for r in hot]
    assert times == sorted(times, key=lambda t: (t is not None, t or 0))
    assert numbered.count() == 6_000
